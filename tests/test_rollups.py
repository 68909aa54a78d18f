import pytest
from pyspark.sql import functions as F

from tidemill.functions import money
from tidemill.operators import rollups
from tidemill.sources import lake
from tidemill.streaming.rollups import RollupTable

SCHEMA = "id long, kind string, amount double, session string"
SPEC = rollups.RollupSpec({"kind": "kind"}, {"revenue": "amount"}, {"sessions": "session"})


def sales(spark, first, last, files=3):
    return spark.range(first, last, numPartitions=files).select(
        "id", F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 3).cast("string"))).alias("kind"),
        ((F.col("id") % 1000) / 100).alias("amount"), F.concat(F.lit("s"), (F.col("id") % 4001).cast("string")).alias("session"),
    )


def figures(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


@pytest.fixture
def table(spark, tmp_path):
    return RollupTable(f"{tmp_path}/rollup", f"{tmp_path}/lake", sales(spark, 0, 1).schema, SPEC)


def test_three_landings_equal_the_whole(spark, table):
    assert table.figures(spark, "kind").collect() == []
    for landing in range(3):
        sales(spark, 9_000 * landing, 9_000 * landing + 9_000).write.mode("append").parquet(table.lake)
        assert table.fresh(spark).count() == 3
        assert table.refresh(spark) == 3 and table.refresh(spark) == 0
    exact = sales(spark, 0, 27_000).groupBy("kind").agg(F.count("*"), money.total(F.col("amount")), F.count_distinct("session"))
    mine, whole = figures(table.figures(spark, "kind")), figures(exact)
    assert {k: v[:2] for k, v in mine.items()} == {k: v[:2] for k, v in whole.items()} and len(mine) == 4
    assert all(abs(v[2] - whole[k][2]) <= 0.05 * whole[k][2] for k, v in mine.items())
    ((rows, revenue, sessions),) = table.figures(spark).collect()
    assert (rows, revenue) == (27_000, sales(spark, 0, 27_000).agg(money.total(F.col("amount"))).first()[0])
    assert abs(sessions - 4001) <= 0.05 * 4001
    assert table.entries(spark).count() == 9


def test_a_refresh_reads_new_files_in_portions(spark, table):
    small = RollupTable(table.path, table.lake, table.schema, SPEC, files_at_once=2)
    sales(spark, 0, 500, files=5).write.mode("append").parquet(table.lake)
    assert small.refresh(spark) == 5
    assert small.entries(spark).select("part").distinct().count() == 3
    assert figures(small.figures(spark)) == {500: (pytest.approx(sum(i % 1000 for i in range(500)) / 100), pytest.approx(500, rel=0.05))}
    # New files are read, old ones may be gone.
    for path in lake.newest_files(spark, table.lake, 9):
        spark.sparkContext._jvm.java.io.File(path.replace("file:", "").replace("///", "/")).delete()
    sales(spark, 500, 600, files=1).write.mode("append").parquet(table.lake)
    assert small.refresh(spark) == 1 and small.figures(spark).first()[0] == 600


def test_what_a_failed_refresh_left_does_not_count(spark, table):
    sales(spark, 0, 100).write.mode("append").parquet(table.lake)
    rollups.partials(sales(spark, 0, 100), SPEC).write.parquet(f"{table.path}/parts/stray")
    assert table.refresh(spark) == 3 and table.figures(spark).first()[0] == 100


def test_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    rows = spark.createDataFrame([(1, "a", nan, None), (2, "a", None, None), (3, None, inf, "s"), (4, None, 1.0, "s")], SCHEMA)
    kept = rollups.partials(rows, SPEC)
    assert figures(rollups.merged(kept, SPEC, "kind")) == {"a": (2, 0.0, 0), None: (2, inf, 1)}
    none = rollups.partials(rows.limit(0), SPEC)
    assert rollups.merged(none, SPEC).collect() == [(0, 0.0, 0)] and rollups.merged(none, SPEC, "kind").collect() == []
