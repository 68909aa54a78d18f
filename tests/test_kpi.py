import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.functions import money, temporal
from tidemill.operators import kpi

DAY = dt.datetime(2024, 1, 1)


def column(spark, data_type, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {data_type}")


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_value_bands(spark):
    values = [None, 0.0, -5.0, 50.0, 0.0, 100.0, 100.01, 500.0, 500.5, float("nan")]
    assert rows(kpi.value_bands(column(spark, "double", values), "v")) == [
        ("0-100", 4), ("100-500", 2), (">500", 1),
    ]
    assert rows(kpi.value_bands(column(spark, "double", [1.0, 2.0]), "v")) == [
        ("0-100", 2), ("100-500", 0), (">500", 0),
    ]
    assert rows(kpi.value_bands(column(spark, "double", []), "v")) == [
        ("0-100", 0), ("100-500", 0), (">500", 0),
    ]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-10, 1000)), max_size=40))
def test_bands_hold_every_non_negative_value(spark, values):
    counted = kpi.value_bands(column(spark, "double", values), "v")
    assert sum(r.orders for r in counted.collect()) == sum(v is not None and v >= 0 for v in values)


def test_revenue_and_mean(spark):
    frame = column(spark, "double", [0.1, 0.2, None, 0.7, float("nan")])
    assert rows(kpi.revenue(frame, "v")) == [(1.0,)]
    assert kpi.average_order_value(frame, "v").first()[0] == pytest.approx(1.0 / 3)
    nothing = column(spark, "double", [])
    assert rows(kpi.revenue(nothing, "v")) == [(0.0,)]
    assert rows(kpi.average_order_value(nothing, "v")) == [(0.0,)]
    assert rows(kpi.average_order_value(column(spark, "double", [None]), "v")) == [(0.0,)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-(10**10) + 1, 10**10 - 1), max_size=30))
def test_sums_are_exact(spark, amounts):
    """Every amount of a decimal(10,2) column, in cents."""
    frame = column(spark, "double", [c / 100 for c in amounts])
    assert rows(kpi.revenue(frame, "v")) == [(sum(amounts) / 100,)]


def test_sums_beyond_a_bigint_of_cents(spark):
    frame = spark.range(2_000).select(F.lit(8.9e16).alias("v"))
    assert rows(kpi.revenue(frame, "v")) == [(8.9e16 * 2_000,)]
    large = column(spark, "double", [1.0, 9.1e16, 5.0, None, float("nan")])
    assert rows(kpi.revenue(large, "v")) == [(pytest.approx(9.1e16 + 6.0),)]
    assert rows(kpi.average_order_value(large, "v")) == [(pytest.approx((9.1e16 + 6.0) / 3),)]
    endless = column(spark, "double", [1.0, float("inf"), 1e300])
    assert rows(kpi.revenue(endless, "v")) == [(float("inf"),)]
    assert rows(kpi.revenue(column(spark, "double", [float("nan"), None]), "v")) == [(0.0,)]


def test_success_rate_counts_missing_status(spark):
    rate = kpi.payment_success_rate(column(spark, "string", ["completed", None, "x"]), "v")
    assert rate.first()[0] == pytest.approx(100 / 3)
    assert rows(kpi.payment_success_rate(column(spark, "string", []), "v")) == [(0.0,)]


def test_counts_and_sums_drop_missing_keys(spark):
    frame = spark.createDataFrame(
        [("a", 1.0), ("b", 2.0), ("b", 3.0), (None, 9.0), ("x", None), ("c", -1.0)],
        "k string, v double",
    )
    assert rows(kpi.count_by(frame, "k")) == [("b", 2), ("a", 1), ("c", 1), ("x", 1)]
    assert rows(kpi.sum_by(frame, "k", "v", "s")) == [
        ("b", 5.0), ("a", 1.0), ("x", 0.0), ("c", -1.0),
    ]


def test_revenue_by_day(spark):
    frame = spark.createDataFrame(
        [
            (DAY.replace(hour=23), 1.0),
            (DAY, 2.0),
            (DAY + dt.timedelta(days=1), None),
            (None, 5.0),
        ],
        "order_date timestamp, total_amount double",
    )
    expected = [(dt.date(2024, 1, 1), 3.0), (dt.date(2024, 1, 2), 0.0)]
    assert rows(kpi.revenue_by_day(frame)) == expected
    text = frame.withColumn("order_date", F.col("order_date").cast("string")).unionByName(
        spark.createDataFrame([("soon", 7.0)], "order_date string, total_amount double")
    )
    assert rows(kpi.revenue_by_day(text)) == expected


def test_hourly_events(spark):
    times = [DAY, DAY.replace(minute=59), DAY.replace(hour=2), None]
    for kind in ("timestamp", "timestamp_ntz"):
        frame = column(spark, kind, times, "event_timestamp")
        series = kpi.hourly_events(frame)
        assert rows(series) == [(DAY, 2), (DAY.replace(hour=2), 1)]
        assert dict(series.dtypes)["event_hour"] == kind


def test_sessions_skip_missing(spark):
    frame = spark.createDataFrame(
        [("a", "purchase"), (None, "purchase"), ("a", None)], "session_id string, event_type string"
    )
    assert rows(kpi.sessions_and_purchases(frame)) == [(1, 2)]
    assert rows(kpi.sessions_and_purchases(frame, approximate=True)) == [(1, 2)]


def test_latest_falls_back(spark):
    frame = spark.createDataFrame(
        [(None, "2024-01-02 03:04:59", dt.date(2024, 5, 6)), (None, "bad", None)],
        "a timestamp, b string, c date",
    )

    def latest(*candidates):
        return kpi.latest_timestamp(frame, list(candidates)).first()[0]

    assert latest("a", "b", "c") == "2024-01-02 03:04"
    assert latest("a", "c") == "2024-05-06 00:00"
    assert latest("a", "absent") == "n/a"
    assert latest("absent") == "n/a"
    assert rows(kpi.latest_timestamp(frame.limit(0), ["b"])) == [("n/a",)]


def test_dataset_health_lists_empty_datasets(spark):
    some = column(spark, "timestamp", [DAY], "order_date")
    none = column(spark, "timestamp", [], "created_at")
    health = kpi.dataset_health(
        {"orders": some, "payments": none},
        {"orders": ["order_date"], "payments": ["created_at"]},
    )
    assert rows(health) == [("orders", 1, "2024-01-01 00:00"), ("payments", 0, "n/a")]


def test_overview_of_nothing(spark):
    orders = column(spark, "double", [], "total_amount")
    payments = column(spark, "string", [], "status")
    card = kpi.overview(orders, payments, spark.range(2), spark.range(0))
    assert rows(card) == [(0, 0.0, 0.0, 0, 2, 0)]
    assert rows(kpi.overview_labels(card)) == [
        ("0", "$0.00", "Average order value: $0.00", "0", "2 / 0")
    ]


def test_funnel(spark):
    visits = {
        "a": kpi.FUNNEL_STEPS,
        "b": kpi.FUNNEL_STEPS[:2],
        "c": kpi.FUNNEL_STEPS[:1],
        "d": ("other",),
        # Reaching a step implies the earlier ones.
        "e": ("purchase",),
        None: ("purchase",),
    }
    frame = spark.createDataFrame(
        [(s, e) for s, steps in visits.items() for e in steps],
        "session_id string, event_type string",
    )
    reached = rows(kpi.funnel_reach(frame))
    assert [r[:3] for r in reached] == [
        (1, "page_view", 4), (2, "add_to_cart", 3), (3, "checkout_start", 2),
        (4, "payment_info", 2), (5, "purchase", 2),
    ]
    assert [r[3] for r in reached] == [1.0, 0.75, 0.5, 0.5, 0.5]
    assert [r[4] for r in reached] == [1.0, 0.75, pytest.approx(2 / 3), 1.0, 1.0]
    assert rows(kpi.funnel_reach(frame.limit(0)))[0] == (1, "page_view", 0, None, None)


def test_charts_of_one_pass(spark):
    frame = spark.createDataFrame(
        [("a", 1, 1.0), ("a", None, 2.0), (None, 2, 4.0)], "k string, n int, v double"
    )
    charts = kpi.in_one_pass(
        frame,
        {"k": F.col("k"), "n": F.col("n")},
        {"rows": F.count("*"), "total": money.total(F.col("v"))},
    )
    assert charts.columns == ["chart", "value", "rows", "total"]
    assert sorted(rows(charts), key=repr) == [
        ("all", None, 3, 7.0), ("k", "a", 2, 3.0), ("n", "1", 1, 1.0), ("n", "2", 1, 4.0),
    ]


def test_sums_beyond_whole_cents_are_doubles(spark):
    """Three million amounts of 8e16, whose high parts run over a bigint together."""
    many = spark.range(3_000_000).select(F.lit(8e16).alias("v"), (F.col("id") % 3).alias("k"))
    assert many.agg(money.total(F.col("v"))).first()[0] == pytest.approx(2.4e23, rel=1e-9)
    assert [r[1] for r in many.groupBy("k").agg(money.total(F.col("v"))).collect()] == pytest.approx([8e22] * 3, rel=1e-9)
    signs = many.select((F.col("v") * F.when(F.col("k") == 0, -1).otherwise(1)).alias("v"))
    assert signs.agg(money.total(F.col("v"))).first()[0] == pytest.approx(8e22, rel=1e-9)
    inf, nan = float("inf"), float("nan")
    odd = spark.createDataFrame([(1, 0.1), (1, 0.2), (1, nan), (2, inf), (2, 1.0), (3, None), (4, nan), (5, -8e16)], "k int, v double")
    found = {r.k: r.t for r in odd.groupBy("k").agg(money.total(F.col("v")).alias("t")).collect()}
    assert found == {1: 0.3, 2: inf, 3: 0.0, 4: 0.0, 5: -8e16}
    # Kept pieces of parts put together give the same.
    for frame in (odd, many.withColumn("k", F.lit(0)).withColumn("v", F.col("v").cast("double"))):
        whole = {r.k: r.t for r in frame.groupBy("k").agg(money.total(F.col("v")).alias("t")).collect()}
        kept = frame.groupBy("k", F.rand(1) > 0.5).agg(*[c.alias(f"v_{n}") for n, c in money.pieces(F.col("v")).items()])
        again = kept.groupBy("k").agg(money.assembled(money.regathered("v_")).alias("t"))
        assert {r.k: r.t for r in again.collect()} == pytest.approx(whole, rel=1e-9)


# Quantity and price; an exact half of a cent goes to the even one.
PRICES = [(3, 1.1), (3, 0.1), (1, 0.125), (-1, 2.5)]


def test_formats(spark):
    frame = spark.range(1).select(
        money.format_count(F.lit(1234567)),
        money.format_currency(F.lit(1234.5)),
        money.format_currency(F.lit(-1234.5)),
        F.concat_ws(" ", *[money.line_total(F.lit(q), F.lit(p)) for q, p in PRICES]),
        temporal.minute_label(F.lit(dt.datetime(2024, 1, 2, 3, 4, 59))),
        temporal.month_tag(F.lit(dt.date(2024, 1, 2))),
    )
    assert rows(frame) == [
        ("1,234,567", "$1,234.50", "$-1,234.50", "3.3 0.3 0.12 -2.5", "2024-01-02 03:04",
         "_202401")
    ]
