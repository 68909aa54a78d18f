import datetime as dt
import random

from pyspark.sql import functions as F

from plans import final_plan, operators
from tidemill.operators import quality, rules

NOON = dt.datetime(2024, 1, 1, 12)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def by_hand(events, first):
    """The previous value of every event, session by session."""
    result, last = [], {}
    for session, time, event, value in sorted(
        events, key=lambda e: (e[1] is not None, e[1] or NOON, e[2])
    ):
        if time is None:
            result.append((event, first))
            continue
        result.append((event, last.get(session, (first,))[0]))
        last[session] = (value,)
    return sorted(result, key=repr)


def test_previous_value_across_cells(spark):
    rng = random.Random(7)
    events = [
        (
            # One session holds most of the events, some have none.
            rng.choice(["hot", "hot", "hot", "b", None]),
            rng.choice([None, NOON + dt.timedelta(rng.choice([0, 0, 1, 40]), rng.randrange(600))]),
            f"e{i:04}",
            rng.choice(["x", "y", None]),
        )
        for i in range(400)
    ]
    schema = "session string, time timestamp, id string, value string"
    frame = spark.createDataFrame(events, schema)
    for cells in (("day", "minute"), ("hour", "minute", "second"), ("second",)):
        linked = rules.with_previous(
            frame, "session", "time", "id", "value", "before", first="root", cells=cells
        )
        assert linked.columns == [*frame.columns, "before"]
        assert rows(linked.select("id", "before")) == by_hand(events, "root")


def test_hot_session_is_spread(spark):
    """A third of the events in one session: no task gets much more than its share."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, setting in settings.items():
        spark.conf.set(key, setting)
    try:
        events = spark.range(0, 60_000, 1, 4).select(
            F.expr("IF(id % 3 = 0, 'hot', concat('s', id DIV 30))").alias("s"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 2).alias("t"),
            F.format_string("%08d", "id").alias("i"),
            F.col("id").cast("string").alias("v"),
        )
        linked = rules.with_previous(events, "s", "t", "i", "v")
        sizes = linked.groupBy(F.spark_partition_id().alias("p")).agg(
            # Counts every row, through the new column, so that it is not pruned away.
            F.count("previous").alias("n")
        )
        assert max(r.n for r in sizes.collect()) < 2 * 60_000 / 16
        hot = linked.where("s = 'hot' AND v <> '0'")
        assert hot.where("CAST(previous AS bigint) = CAST(v AS bigint) - 3").count() == 19_999
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_first_page_comes_from_the_site_root(spark):
    frame = spark.createDataFrame([("s", NOON, "e", "p")], "s string, t timestamp, i string, v string")
    assert rows(rules.with_previous(frame, "s", "t", "i", "v").select("previous")) == [
        (rules.SITE_ROOT,)
    ]


def test_totals(spark):
    items = spark.createDataFrame(
        [("o1", 2, 1.1), ("o1", 3, 0.1), ("o2", 1, 5.0)],
        "order_id string, quantity long, unit_price double",
    )
    assert rows(rules.order_rollup(items)) == [("o1", 2, 2.5), ("o2", 1, 5.0)]
    orders = spark.createDataFrame(
        [("o1", 2.5), ("o2", 5.01), ("o3", 1.0), ("o4", None)],
        "order_id string, total_amount double",
    )
    assert rows(rules.order_total_mismatches(orders, items)) == [("o2", 5.01, 5.0), ("o3", 1.0, None)]
    payments = spark.createDataFrame(
        [("p1", "o1", 2.5), ("p2", "o1", 2.4), ("p3", "none", 1.0)],
        "payment_id string, order_id string, amount double",
    )
    assert rows(rules.payment_amount_mismatches(payments, orders)) == [
        ("p2", "o1", 2.4, 2.5), ("p3", "none", 1.0, None),
    ]


def test_large_amounts_are_compared(spark):
    orders = spark.createDataFrame([("o", 9.2e16), ("s", 9.1e16)], "order_id string, total_amount double")
    payments = spark.createDataFrame(
        [("p", "o", 9.1e16), ("q", "s", 9.1e16), ("r", "s", 1.0)], "payment_id string, order_id string, amount double"
    )
    found = rows(rules.payment_amount_mismatches(payments, orders))
    assert found == [("p", "o", 9.1e16, 9.2e16), ("r", "s", 1.0, 9.1e16)]


def test_payment_lag_window(spark):
    orders = spark.createDataFrame([("o", NOON)], "order_id string, order_date timestamp")
    times = {
        "early": NOON - dt.timedelta(seconds=1),
        "same": NOON,
        "later": NOON + dt.timedelta(minutes=59, seconds=59),
        "edge": NOON + dt.timedelta(minutes=60),
        "late": NOON + dt.timedelta(minutes=60, seconds=1),
        "never": None,
    }
    payments = spark.createDataFrame(
        [(p, "o", t) for p, t in times.items()],
        "payment_id string, order_id string, created_at timestamp",
    )
    assert rows(rules.payment_lag(payments, orders)) == [
        ("edge", "o", 60), ("later", "o", 59), ("same", "o", 0),
    ]


def test_resolution_minutes_are_cut_towards_zero(spark):
    cases = spark.createDataFrame(
        [
            (NOON, NOON + dt.timedelta(seconds=119)),
            (NOON, NOON - dt.timedelta(seconds=119)),
            (NOON, None),
        ],
        "a timestamp, b timestamp",
    )
    minutes = rules.with_resolution_minutes(cases, "a", "b", "m")
    assert [r.m for r in minutes.orderBy(F.desc_nulls_last("b")).collect()] == [1, -1, None]


def test_month_tag(spark):
    frame = spark.createDataFrame([(dt.date(2024, 2, 3),)], "d date")
    assert rows(rules.with_month_tag(frame, "d")) == [
        (dt.date(2024, 2, 3), "_202402", dt.datetime(2024, 2, 3))
    ]


def test_hot_customer_is_split_among_tasks(spark):
    """Where customers are too many to broadcast, the partition of a hot one is cut up."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        orders = spark.range(0, 60_000, 1, 8).select(
            F.col("id").cast("string").alias("order_id"),
            F.when(F.col("id") < 20_000, F.lit("hot"))
            .otherwise(F.col("id").cast("string"))
            .alias("customer_id"),
            F.uuid().alias("shipping_address"),
            F.uuid().alias("status"),
        )
        customers = spark.range(20_000, 60_000).select(
            F.col("id").cast("string").alias("customer_id"), F.uuid().alias("address")
        )
        hot = spark.createDataFrame([("hot", "Hot Street")], "customer_id string, address string")
        joined = rules.orders_with_customer(orders, customers.union(hot))
        assert len(joined.collect()) == 60_000
        assert "skew=true" in final_plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_constraints(spark):
    child = spark.createDataFrame(
        [("a", 1.0, "xx"), ("a", 99_999_999.99, "xxx"), ("b", 100_000_000.0, None), (None, None, "")],
        "k string, v double, s string",
    )
    parent = spark.createDataFrame([("a",), ("a",)], "id string")
    assert rows(quality.orphans(child, "k", parent, "id")) == [("b", 1)]
    assert rows(quality.duplicate_keys(child, "k")) == [("a", 2)]
    table_rules = quality.TableRules(
        unique=("k",), required=("s",), max_length={"s": 2}, money=("v",)
    )
    assert rows(quality.table_violations(child, table_rules)) == [
        ("k is null", 1),
        ("s is null", 1),
        ("s over 2 characters", 1),
        ("v is no decimal(10,2)", 1),
    ]


def test_orphans_hold_each_key_once_and_sort_nothing(spark):
    child = spark.range(0, 30_000).selectExpr("IF(id % 10 = 0, NULL, CAST(id % 7000 AS string)) AS k")
    parent = spark.range(0, 9_000).selectExpr("IF(id % 9 = 0, NULL, CAST(id + 100 AS string)) AS id")
    found = quality.orphans(child, "k", parent, "id")
    keys = [str(i % 7000) for i in range(30_000) if i % 10]
    held = {str(i + 100) for i in range(9_000) if i % 9}
    assert rows(found) == sorted((k, keys.count(k)) for k in set(keys) - held)
    kinds = [n.getClass().getSimpleName() for n in operators(found)]
    assert not [k for k in kinds if "Join" in k or k == "SortExec"]
    assert kinds.count("ShuffleExchangeExec") == 1


def test_rule_names_are_plain_text(spark):
    frame = spark.createDataFrame([(1,), (None,)], "n int")
    found = quality.violations(frame, {"owner's \"n\"": "n IS NULL", "`odd`": "n > 5"})
    assert rows(found) == [("`odd`", 0), ("owner's \"n\"", 1)]
