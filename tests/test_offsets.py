import json
import re

import pytest
from pyspark.sql import functions as F

from plans import operators

from tidemill.sources import offsets
from tidemill.sources.logs import LOG_SCHEMA, FileLog

TOPICS = "key string, topic string"


def keyed(spark, topic, first, last):
    return spark.range(first, last).select(
        F.col("id").cast("string").cast("binary").alias("key"), F.lit(topic).alias("topic"), F.lit(b"v").alias("value")
    )


def at(spark, places):
    """Log rows at (topic, partition, offset)."""
    rows = [(b"k", b"v", p, o, None, 0, t) for t, p, o in places]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def wanted(spark, *rows):
    return spark.createDataFrame(list(rows), offsets.RANGE_SCHEMA)


def places(frame):
    return sorted((r.topic, r.partition, r.offset) for r in frame.collect())


@pytest.fixture
def log(spark, tmp_path):
    log = FileLog(f"{tmp_path}/log", partitions=3)
    log.append(keyed(spark, "a", 0, 50).repartition(5))
    log.append(keyed(spark, "a", 50, 80).unionByName(keyed(spark, "b", 0, 7)))
    return log


def test_offsets_go_on_without_gaps(spark, log):
    found = places(log.messages(spark))
    assert len(found) == 87
    for topic in "ab":
        for partition in range(3):
            mine = [o for t, p, o in found if (t, p) == (topic, partition)]
            assert mine == list(range(len(mine)))
    # A key stays in its partition, and keeps the order of its messages.
    log.append(keyed(spark, "a", 0, 50))
    again = log.messages(spark).where("topic = 'a'").groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert {r.n for r in again.collect()} == {1}


def shuffled_rows(frame):
    """Rows of the shuffles and windows that the executed frame itself had."""
    frame.collect()
    kinds = [(n.getClass().getSimpleName(), n) for n in operators(frame)]
    assert not [k for k, _ in kinds if k in ("WindowExec", "SortExec")]
    return sum(n.metrics().apply("shuffleRecordsWritten").value() for k, n in kinds if k == "ShuffleExchangeExec")


def test_messages_are_numbered_without_a_shuffle(spark):
    messages = keyed(spark, "a", 0, 4000).repartition(3).unionByName(keyed(spark, "b", 0, 900))
    ends = spark.createDataFrame([("a", 0, 0, 7)], "topic string, partition int, first long, end long")
    rows = offsets.numbered(messages, ends, 2)
    assert shuffled_rows(rows) == 0
    found = places(rows)
    for topic, partition, first in (("a", 0, 7), ("a", 1, 0), ("b", 0, 0), ("b", 1, 0)):
        mine = [o for t, p, o in found if (t, p) == (topic, partition)]
        assert mine == list(range(first, first + len(mine)))
    assert len(found) == 4900


@pytest.mark.parametrize("writers, partitions", [("16", 1), ("2", 1), ("0", 1), ("2", 5)])
def test_a_task_keeps_the_order_of_its_messages(spark, writers, partitions):
    """More topics in a task than files that it keeps open, or more partitions in a file."""
    messages = spark.range(0, 3000, numPartitions=2).select(
        (F.col("id") % 11).cast("string").cast("binary").alias("key"),
        F.concat(F.lit("t"), F.pmod(F.xxhash64("id"), F.lit(5)).cast("string")).alias("topic"),
        F.col("id").cast("string").cast("binary").alias("value"),
    )
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", writers)
    try:
        rows = offsets.numbered(messages, spark.createDataFrame([], "topic string, partition int, end long"), partitions).collect()
    finally:
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "16")
    assert sorted(int(r.value) for r in rows) == list(range(3000))
    for place in {(r.topic, r.partition) for r in rows}:
        mine = sorted((r.offset, int(r.value)) for r in rows if (r.topic, r.partition) == place)
        assert [o for o, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted(v for _, v in mine)


def test_offsets_in_an_order_take_no_task_for_a_whole_partition(spark):
    ids = spark.range(0, 5000).select(F.expr("IF(id % 100 = 7, NULL, id * 37 % 4999)").alias("id"), F.lit("a").alias("topic"))
    rows = offsets.in_order(ids.withColumn("partition", F.pmod("id", F.lit(3)).cast("int")), F.col("id"))
    assert shuffled_rows(rows) == 0
    found = rows.collect()
    assert len(found) == 5000 and rows.columns == ["id", "topic", "partition", "offset"]
    for partition in (None, 0, 1, 2):
        mine = sorted((r.offset, r.id) for r in found if r.partition == partition)
        assert mine and [o for o, _ in mine] == list(range(len(mine)))
        assert partition is None or [i for _, i in mine] == sorted(i for _, i in mine)


def test_reads_between_positions(spark, log):
    ends = {r.partition: r.end for r in offsets.marks(log.messages(spark, "a")).collect()}
    assert sum(ends.values()) == 80
    asked = json.dumps({"a": {"0": 3, "1": -1}})
    got = places(log.read(spark, "a", starting=asked))
    assert got == [("a", 0, o) for o in range(3, ends[0])] + [("a", 2, o) for o in range(ends[2])]
    got = places(log.read(spark, "a", ending=json.dumps({"a": {"0": 2, "1": -2}})))
    assert got == [("a", 0, 0), ("a", 0, 1)] + [("a", 2, o) for o in range(ends[2])]
    assert log.read(spark, "a", starting="latest").isEmpty()
    assert log.read(spark, "nothing", starting="latest").isEmpty()


def test_bounds_reach_the_reader(spark, log):
    rows = log.read(spark, "a", starting=json.dumps({"a": {"0": 3}}))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"DataFilters: \[[^\]]*offset#\d+L >= \S*[Ss]ubquery", plan), plan


@pytest.mark.parametrize("cell", [1 << 20, 4, 1])
def test_missing_stretches(spark, cell):
    held = [("a", 0, o) for o in (2, 3, 4, 7, 8, 20, 21, 21)] + [("a", 1, o) for o in range(5)] + [("b", 0, 9)]
    asked = wanted(spark, ("a", 0, 0, 25), ("a", 1, 0, 5), ("a", 2, 3, 6), ("b", 0, 9, 9), ("c", 0, 0, 0))
    found = offsets.missing(at(spark, held), asked, cell)
    assert sorted(map(tuple, found.select("topic", "partition", "start", "end").collect())) == [
        ("a", 0, 0, 2), ("a", 0, 5, 7), ("a", 0, 9, 20), ("a", 0, 22, 25), ("a", 2, 3, 6),
    ]


def test_a_reader_takes_each_message_once(spark, log, tmp_path):
    ledger, taken = offsets.Ledger(f"{tmp_path}/ledger"), []
    for batch in range(3):
        messages = log.messages(spark)
        first, ranges = ledger.take(messages, "r", batch)
        # The log grows before the batch is noted; the batch as noted stays the same.
        log.append(keyed(spark, "b", 100 * batch, 100 * batch + 5))
        ledger.note(ranges, "r", batch)
        ledger.note(ranges, "r", batch)
        again, _ = ledger.take(log.messages(spark), "r", batch)
        assert places(again) == places(first)
        taken += places(first)
    taken += places(ledger.take(log.messages(spark), "r", 3)[0])
    assert sorted(taken) == places(log.messages(spark)) and len(taken) == 102
    assert ledger.take(log.messages(spark), "r", 3)[0].count() == 5
    assert ledger.entries(spark).count() == sum(ledger.entries(spark).where(f"batch = {b}").count() for b in range(3))


def test_a_reader_may_begin_at_the_end(spark, log, tmp_path):
    ledger = offsets.Ledger(f"{tmp_path}/ledger")
    rows, ranges = ledger.take(log.messages(spark), "r", 0, starting="latest")
    assert rows.isEmpty()
    ledger.note(ranges, "r", 0)
    log.append(keyed(spark, "a", 0, 9).unionByName(keyed(spark, "new", 0, 4)))
    rows, _ = ledger.take(log.messages(spark), "r", 1, starting="latest")
    assert rows.count() == 13


def test_lost_offsets_are_an_error_unless_told(spark, tmp_path):
    ledger = offsets.Ledger(f"{tmp_path}/ledger")
    whole = at(spark, [("a", 0, o) for o in range(10)])
    ledger.note(offsets.ranges(whole, ending='{"a": {"0": 4}}'), "r", 0)
    aged = whole.where("offset > 6")
    with pytest.raises(offsets.DataLoss, match="a-0 4 to 6"):
        ledger.take(aged, "r", 1)
    assert places(ledger.take(aged, "r", 1, whole=False)[0]) == [("a", 0, o) for o in (7, 8, 9)]


def test_a_stream_follows_from_offsets(spark, log, tmp_path):
    """Messages in a file of the same moment as the newest one are not passed over."""

    def landed(stream, name):
        stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c-{name}").trigger(
            availableNow=True
        ).start(f"{tmp_path}/{name}").awaitTermination()
        return places(spark.read.schema(stream.schema).parquet(f"{tmp_path}/{name}"))

    follow, match = log.stream(spark, "a", "latest"), log.stream_matching(spark, "a|b", "latest")
    middle = log.stream(spark, "a", json.dumps({"a": {"0": 5, "1": -1, "2": -1}}))
    before = set(places(log.messages(spark)))
    log.append(keyed(spark, "a", 0, 6).unionByName(keyed(spark, "b", 7, 9)).unionByName(keyed(spark, "c", 7, 9)))
    fresh = set(places(log.messages(spark))) - before
    assert set(landed(follow, "follow")) == {p for p in fresh if p[0] == "a"}
    assert set(landed(match, "match")) == {p for p in fresh if p[0] in "ab"}
    assert set(landed(middle, "middle")) == {p for p in fresh | before if p[0] == "a" and (p in fresh or p[1] == 0 and p[2] >= 5)}


def test_a_log_without_offsets_has_no_end(spark, tmp_path):
    log = FileLog(f"{tmp_path}/log")
    log.append(at(spark, [("a", 0, None)]))
    assert log.messages(spark).count() == 1
    with pytest.raises(ValueError, match="without offsets"):
        log.stream(spark, "a", "latest")
