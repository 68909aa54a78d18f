import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill import catalog
from tidemill.functions import temporal
from tidemill.operators import envelope
from tidemill.operators.enrich import add_ingestion_metadata, convert_times, enrich

SPEC = catalog.dataset("orders", "order_id, order_date epoch_ms, total_amount double")
AFTER = '{"op":"c","after":{"order_id":%s,"order_date":%s,"total_amount":%s}}'
NOW = dt.datetime(2024, 1, 2, 3, 4, 5)

# name, message, decoded (op, key, date, amount), lands
MESSAGES = [
    (
        "extra fields",
        '{"op":"c","before":null,"after":{"order_id":"o1","order_date":1700000000000,'
        '"total_amount":12.5,"zz":1},"ts_ms":1}',
        ("c", "o1", 1700000000000, 12.5),
        True,
    ),
    ("delete", '{"op":"d","before":{"order_id":"o1"},"after":null}', ("d", None, None, None), False),
    ("tombstone", None, (None, None, None, None), False),
    ("malformed", '{"op":"c","after":{"order_id":"o1"', (None, None, None, None), False),
    ("empty", "", (None, None, None, None), False),
    ("bad type", AFTER % ('"o1"', '"x"', 12.5), ("c", "o1", None, 12.5), True),
    ("number as text", AFTER % ('"o1"', '"17"', '"12.5"'), ("c", "o1", None, None), True),
    ("fraction in long", AFTER % ('"o1"', 1.5, 3), ("c", "o1", None, 3.0), True),
    ("numeric key", AFTER % (77, 1, 3), ("c", "77", 1, 3.0), True),
    (
        "wrapped with its schema",
        '{"schema":{},"payload":{"op":"c","after":{"order_id":"o1"}}}',
        (None, None, None, None),
        False,
    ),
    ("array", '[{"op":"c","after":{"order_id":"a1"}}]', (None, None, None, None), False),
    ("missing key", '{"op":"u","after":{"total_amount":3}}', ("u", None, None, 3.0), False),
]


def log_of(spark, messages, topic="shop.public.orders"):
    rows = [(m if m is None else m.encode(), topic, NOW) for m in messages]
    return spark.createDataFrame(rows, "value binary, topic string, timestamp timestamp")


@pytest.fixture(scope="module")
def decoded(spark):
    """Every message decoded on its own, without the key filter, and whether it lands."""
    result = {}
    for name, message, _, _ in MESSAGES:
        log = log_of(spark, [message])
        parsed = envelope.parse_messages(log, SPEC).select("op", "after.*").collect()
        result[name] = (tuple(parsed[0]), envelope.decode(log, SPEC).collect())
    return result


@pytest.mark.parametrize("name, message, fields, lands", MESSAGES, ids=[m[0] for m in MESSAGES])
def test_message(decoded, name, message, fields, lands):
    parsed, landed = decoded[name]
    assert parsed == fields
    assert [tuple(r) for r in landed] == ([(NOW, *fields)] if lands else [])


def test_decoding_and_rejects_share_every_message(spark):
    log = log_of(spark, [m[1] for m in MESSAGES])
    landed = envelope.decode(log, SPEC).count()
    rejected = envelope.rejected(log, SPEC).collect()
    assert landed == sum(m[3] for m in MESSAGES)
    assert landed + len(rejected) == len(MESSAGES)
    assert {r.message for r in rejected} == {m[1] for m in MESSAGES if not m[3]}
    assert {r.op for r in rejected if r.message and "before" in r.message} == {"d"}


def test_each_message_is_parsed_once(spark, tmp_path):
    log_of(spark, [m[1] for m in MESSAGES]).write.parquet(str(tmp_path / "log"))
    rows = envelope.decode(spark.read.parquet(str(tmp_path / "log")), SPEC)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_clicks_are_all_kept(spark):
    click = {
        "event_id": "e1",
        "session_id": "s1",
        "customer_id": 5,
        "event_type": "page_view",
        "page_url": "https://example.com/page_view",
        "event_timestamp": "2024-01-02T03:04:05.123456",
        "properties": json.dumps({"user_agent": "x"}),
    }
    messages = [json.dumps(click), "garbage", None, json.dumps({"event_timestamp": "soon"})]
    rows = envelope.decode(log_of(spark, messages), catalog.WEB_EVENTS)
    assert rows.columns == [
        "kafka_timestamp", "event_id", "session_id", "customer_id", "event_type", "event_timestamp",
    ]
    landed = convert_times(rows, catalog.WEB_EVENTS).collect()
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert sorted(map(tuple, landed), key=repr) == sorted(
        [(NOW, "e1", "s1", "5", "page_view", moment)] + 3 * [(NOW,) + 5 * (None,)], key=repr
    )


def test_peek_and_topic_exclusion(spark):
    known = log_of(spark, ['{"op":"c","after":{"order_id":"o1"}}'])
    stray = log_of(spark, ['{"op":"c","after":{"a":{"b":1}}}', "junk"], "shop.public.returns")
    seen = envelope.without_topics(envelope.peek(known.union(stray)), ["shop.public.orders"])
    assert sorted(map(tuple, seen.drop("kafka_timestamp").collect()), key=repr) == [
        ("shop.public.returns", "c", '{"a":{"b":1}}'),
        ("shop.public.returns", None, None),
    ]
    assert envelope.without_topics(known, []).count() == 1


def test_landed_columns_and_schema(spark):
    for spec in catalog.DATASETS:
        landed = enrich(envelope.decode(log_of(spark, []), spec), spec)
        assert [(f.name, f.dataType) for f in landed.schema] == [
            (f.name, f.dataType) for f in spec.landed_schema()
        ]
    assert catalog.ORDERS.landed_schema().names == [
        "kafka_timestamp", "op", "order_id", "customer_id", "total_amount", "status",
        "shipping_address", "order_date", "_ingested_at", "year", "month", "day", "hour",
    ]


def test_encoding_writes_nulls_and_empty_deletes(spark):
    rows = spark.createDataFrame(
        [("o1", dt.datetime(2024, 1, 2), None)],
        "order_id string, order_date timestamp, total_amount double",
    )
    messages = envelope.encode(rows, SPEC, "shop", "u").union(
        envelope.encode(rows, SPEC, "shop", "d")
    )
    update, delete = [json.loads(bytes(r.value)) for r in messages.collect()]
    assert update == {
        "op": "u",
        "after": {"order_id": "o1", "order_date": 1704153600000, "total_amount": None},
    }
    assert delete == {"op": "d", "after": None}
    assert messages.first().topic == "shop.public.orders"


def test_event_messages_keep_nulls_and_use_iso_times(spark):
    rows = spark.createDataFrame(
        [("e1", None, dt.datetime(2024, 1, 2, 3, 4, 5)), ("e2", "x", NOW.replace(microsecond=7))],
        "event_id string, note string, event_timestamp timestamp",
    )
    sent = [json.loads(bytes(r.value)) for r in envelope.event_messages(rows).collect()]
    times = [dt.datetime(2024, 1, 2, 3, 4, 5), NOW.replace(microsecond=7)]
    assert sent == [
        {"event_id": "e1", "note": None, "event_timestamp": times[0].isoformat()},
        {"event_id": "e2", "note": "x", "event_timestamp": times[1].isoformat()},
    ]


def values(spark, data_type, inputs, convert):
    rows = [(i, v) for i, v in enumerate(inputs)]
    frame = spark.createDataFrame(rows, f"i int, v {data_type}")
    return [r[0] for r in frame.orderBy("i").select(convert(F.col("v"))).collect()]


def test_epoch_millis(spark):
    inputs = [1700000000789, -1, -1500, None, 9 * 10**18, 1699165800000]
    exact = values(
        spark, "bigint", inputs, lambda c: F.unix_millis(temporal.epoch_millis(c))
    )
    assert exact == [1700000000789, -1, -1500, None, None, 1699165800000]
    whole = values(
        spark, "bigint", inputs, lambda c: F.unix_millis(temporal.epoch_millis(c, True))
    )
    assert whole == [1700000000000, 0, -1000, None, None, 1699165800000]


def test_epoch_days(spark):
    days = values(spark, "bigint", [19700, -1, None, 1700000000000], temporal.epoch_days)
    assert days == [dt.date(2023, 12, 9), dt.date(1969, 12, 31), None, None]


def test_iso_timestamps(spark):
    inputs = [
        "2024-01-02T03:04:05", "2024-01-02T03:04:05.123456", "2024-01-02T03:04:05Z",
        "2024-01-02T03:04:05+02:00", "2024-01-02", "garbage", "", None,
    ]
    second = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert values(spark, "string", inputs, temporal.iso_timestamp) == [
        second, second.replace(microsecond=123456), second, second.replace(hour=1),
        dt.datetime(2024, 1, 2), None, None, None,
    ]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(temporal.MIN_MILLIS, temporal.MAX_MILLIS), min_size=1, max_size=50))
def test_millis_round_trip(spark, millis):
    back = values(
        spark, "bigint", millis, lambda c: temporal.to_epoch_millis(temporal.epoch_millis(c))
    )
    assert back == millis


def test_ingestion_metadata(spark):
    one = spark.range(3)
    stamped = add_ingestion_metadata(one, F.lit(dt.datetime(2024, 3, 4, 5, 6, 7)))
    assert stamped.drop("id", "_ingested_at").distinct().collect() == [("2024", "03", "04", "05")]
    assert add_ingestion_metadata(one).select("_ingested_at").distinct().count() == 1
