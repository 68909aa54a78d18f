import datetime as dt

import pytest
from pyspark.sql import functions as F

from plans import final_plan, operators
from tidemill.operators import rules
from tidemill.sources.buckets import land_bucketed

NOW = dt.datetime(2024, 1, 1)


@pytest.fixture
def tables(spark, tmp_path):
    """Orders, lines and payments of 300 orders, one of them with most lines."""
    orders = spark.range(300).select(F.concat(F.lit("o"), "id").alias("order_id"), F.lit(NOW).alias("order_date"), (F.col("id") % 5 * 1.0).alias("total_amount"))
    lines = spark.range(900).select(
        F.concat(F.lit("o"), F.when(F.col("id") < 400, 7).otherwise(F.col("id") % 310)).alias("order_id"),
        (F.col("id") % 3).cast("int").alias("quantity"), F.lit(1.0).alias("unit_price"),
    )
    payments = spark.range(300).select(
        F.concat(F.lit("p"), "id").alias("payment_id"), F.concat(F.lit("o"), F.col("id") % 290).alias("order_id"),
        (F.lit(NOW) + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("created_at"), F.lit(2.0).alias("amount"),
    )
    frames = {"orders": orders, "lines": lines, "payments": payments}
    for name, frame in frames.items():
        land_bucketed(frame.limit(100), f"t_{name}", f"{tmp_path}/{name}", "order_id", 4)
        land_bucketed(frame.exceptAll(frame.limit(100)), f"t_{name}", f"{tmp_path}/{name}", "order_id", 4)
    yield frames, {name: spark.table(f"t_{name}") for name in frames}
    for name in frames:
        spark.sql(f"DROP TABLE t_{name}")


def reports(frames):
    return {
        "rollup": rules.order_rollup(frames["lines"]),
        "totals": rules.order_total_mismatches(frames["orders"], frames["lines"]),
        "payments": rules.payment_amount_mismatches(frames["payments"], frames["orders"]),
        "lags": rules.payment_lag(frames["payments"], frames["orders"]),
    }


def test_reports_of_buckets_need_no_exchange(spark, tables):
    plain, kept = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for (name, expected), found in zip(reports(plain).items(), reports(kept).values()):
            assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr), name
            assert not any("Exchange" in node.getClass().getSimpleName() for node in operators(found)), name
            assert "Exchange" in final_plan(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(kept["orders"].inputFiles()) <= 8
