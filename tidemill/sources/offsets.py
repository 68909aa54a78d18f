"""Offsets of a log: numbering, marks, ranges, gaps, and a ledger of what readers have taken.

Marks and ranges are small tables, a row for each topic partition; rows of the log are
only ever filtered by them or summed up to them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.session import stage, unstage
from tidemill.sources.lake import has_data

PLACE = ["topic", "partition"]
RANGE_SCHEMA = "topic string, partition int, start long, end long"
LEDGER_SCHEMA = f"reader string, batch long, {RANGE_SCHEMA}"

# Names and numbers for the ends of a topic partition.
EARLIEST, LATEST = "earliest", "latest"
EARLIEST_NUMBER, LATEST_NUMBER = -2, -1

GAP_CELL = 1 << 20


class DataLoss(ValueError):
    """Offsets that a reader wants are not in the log."""


def marks(messages: DataFrame) -> DataFrame:
    """(topic, partition, first, end): the least offset, and one past the greatest."""
    return messages.groupBy(*PLACE).agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("end"))


def numbered(messages: DataFrame, ends: DataFrame, partitions: int) -> DataFrame:
    """Messages with partition and offset: a key's messages in one partition, in the order of their
    tasks, and messages without key in one.

    Offsets go on from ``ends`` (topic, partition, end) without gaps. Messages are written once, by
    place, and each file is counted: a message's offset is its file's first offset and its row in
    the file, so that no message is shuffled or sorted. Only where a file may be out of order, or
    holds several places, its rows are numbered by a window over the file.
    """
    spark = messages.sparkSession
    writers = int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
    key = F.col("key") if "key" in messages.columns else F.lit(None).cast("binary")
    place = F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")
    held = stage(
        messages.where(F.col("topic").isNotNull()).drop("partition", "offset").withColumns(
            {"partition": place, "__row": F.monotonically_increasing_id()}
        ),
        "messages",
        *(PLACE if partitions <= writers else PLACE[:1]),
    ).withColumns({"__file": F.col("_metadata.file_path"), "__place": F.col("_metadata.row_index")})
    counts = held.groupBy("__file", *PLACE).agg(F.count("*").alias("n"), F.min("__row").alias("__first"))
    before = Window.partitionBy(*PLACE).orderBy("__first").rowsBetween(Window.unboundedPreceding, -1)
    # A task with more places than open writers sorts what it writes, and not by row.
    task = Window.partitionBy(F.shiftright("__first", 33))
    straight = (F.count("*").over(task) <= writers) & (F.count("*").over(Window.partitionBy("__file")) == 1)
    counts = counts.withColumns({"__before": F.coalesce(F.sum("n").over(before), F.lit(0)), "__straight": straight})
    # A short row for each file, written so that its size is known.
    bases = stage(
        counts.join(ends.select(*PLACE, "end"), PLACE, "left").select(
            "__file", "partition", (F.coalesce("end", F.lit(0)) + F.col("__before")).alias("__base"), "__straight"
        ),
        "bases",
    )
    based = held.join(bases, ["__file", "partition"])
    rows = based.where("__straight")
    if not bases.where("NOT __straight").isEmpty():
        order = F.row_number().over(Window.partitionBy("__file", "partition").orderBy("__row"))
        rows = rows.unionByName(based.where("NOT __straight").withColumn("__place", order - 1))
    return rows.withColumn("offset", F.col("__base") + F.col("__place")).drop("__row", "__file", "__place", "__base", "__straight")


def in_order(messages: DataFrame, order: Column) -> DataFrame:
    """Messages that have a partition, with offsets from 0 on in the order of ``order``; of messages
    that tie, any may come first.

    Ranges of the order are sorted and written, each by a task of its own, and counted. An offset
    is that of the first row of its range and the rows before it there, so that a partition of any
    size is no single task.
    """
    ranged_by = ["partition", "__order"]
    dealt = messages.withColumn("__order", order).repartitionByRange(*ranged_by).sortWithinPartitions(*ranged_by)
    held = stage(dealt, "ordered").withColumns({"__file": F.col("_metadata.file_path"), "__place": F.col("_metadata.row_index")})
    counts = held.groupBy("__file", "partition").agg(
        F.count("*").alias("n"), F.min("__place").alias("low"), F.min("__order").alias("first")
    )
    before = Window.partitionBy("partition").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")
    # A short row for each file, written so that its size is known.
    bases = stage(counts.select(F.col("__file").alias("file"), F.col("partition").alias("of"), base.alias("base")), "bases")
    same = (F.col("__file") == F.col("file")) & F.col("partition").eqNullSafe(F.col("of"))
    placed = held.join(bases, same).withColumn("offset", F.col("base") + F.col("__place"))
    return placed.drop("__order", "__file", "__place", "file", "of", "base")


def positions(known: DataFrame, position: str, column: str) -> DataFrame:
    """(topic, partition, ``column``) of a position: ``earliest``, ``latest``, or offsets as JSON.

    JSON is that of a Kafka reader: ``{"topic": {"0": 23, "1": -2}}``, where -2 is the earliest and
    -1 the latest. Of partitions that it does not name, all is taken.
    """
    if position in (EARLIEST, LATEST):
        return known.select(*PLACE, F.col("first" if position == EARLIEST else "end").alias(column))
    asked = [
        (topic, int(partition), int(offset))
        for topic, offsets in json.loads(position).items() for partition, offset in offsets.items()
    ]
    table = known.sparkSession.createDataFrame(asked, "topic string, partition int, asked long")
    found = (
        F.when(F.col("asked") >= 0, F.col("asked"))
        .when(F.col("asked") == LATEST_NUMBER, F.col("end"))
        .when(F.col("asked") == EARLIEST_NUMBER, F.col("first"))
        .otherwise(F.col("first" if column == "start" else "end"))
    )
    return known.join(table, PLACE, "left").select(*PLACE, found.alias(column))


def ranges(messages: DataFrame, starting: str = EARLIEST, ending: str = LATEST) -> DataFrame:
    """(topic, partition, start, end) between two positions of a log as it is now."""
    known = stage(marks(messages), "marks")
    found = stage(positions(known, starting, "start").join(positions(known, ending, "end"), PLACE), "ranges")
    unstage(known)
    return found


def ranged(messages: DataFrame, wanted: DataFrame) -> DataFrame:
    """The messages of the ranges (topic, partition, start, end). The outermost offsets reach the
    reader, which skips row groups by them."""
    least, most = wanted.agg(F.min("start")).scalar(), wanted.agg(F.max("end")).scalar()
    near = messages.where((F.col("offset") >= least) & (F.col("offset") < most))
    inside = (F.col("offset") >= F.col("start")) & (F.col("offset") < F.col("end"))
    bounds = wanted.select(*PLACE, "start", "end")
    return near.join(bounds, PLACE).where(inside).select(*messages.columns)


def missing(messages: DataFrame, wanted: DataFrame, cell: int = GAP_CELL) -> DataFrame:
    """(topic, partition, start, end): the stretches of the wanted ranges that the log does not hold.

    Offsets are counted in cells. Only cells that are not full are looked at row by row, and
    what lies between cells is found from the first and last offset of each.
    """
    rows = ranged(messages, wanted).select(*PLACE, "offset").withColumn("cell", F.floor(F.col("offset") / cell))
    cells = stage(
        rows.groupBy(*PLACE, "cell").agg(
            F.count_distinct("offset").alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high")
        ),
        "cells",
    )
    torn = cells.where(F.col("n") <= F.col("high") - F.col("low")).select(*PLACE, "cell")
    within = Window.partitionBy(*PLACE, "cell").orderBy("offset")
    steps = rows.join(torn, [*PLACE, "cell"], "left_semi").withColumn("start", F.lag("offset").over(within) + 1)
    inner = steps.where(F.col("start") < F.col("offset")).select(*PLACE, "start", F.col("offset").alias("end"))

    # What is wanted ends with a cell of nothing.
    edges = cells.select(*PLACE, "low", "high").unionByName(
        wanted.select(*PLACE, F.col("end").alias("low"), F.col("end").alias("high"))
    )
    by_place = Window.partitionBy(*PLACE).orderBy("low", "high")
    after = edges.withColumn("before", F.lag("high").over(by_place) + 1).join(wanted.select(*PLACE, F.col("start").alias("from")), PLACE)
    outer = after.select(*PLACE, F.coalesce("before", "from").alias("start"), F.col("low").alias("end"))
    return inner.unionByName(outer.where(F.col("start") < F.col("end")))


def check_whole(messages: DataFrame, wanted: DataFrame) -> None:
    """Raise ``DataLoss`` if the log does not hold all that is wanted."""
    lost = missing(messages, wanted).orderBy(*PLACE, "start").limit(3).collect()
    if lost:
        named = ", ".join(f"{r.topic}-{r.partition} {r.start} to {r.end - 1}" for r in lost)
        raise DataLoss(f"offsets are not in the log: {named}")


@dataclass(frozen=True)
class Ledger:
    """A folder that notes which ranges each reader has taken.

    A batch is a number that a reader gives each of its turns. It is noted after its rows are
    safe; the same batch again takes the same ranges, so that a turn cut short is repeated
    and not passed over.
    """

    path: str

    def entries(self, spark: SparkSession) -> DataFrame:
        if not has_data(spark, self.path):
            return spark.createDataFrame([], LEDGER_SCHEMA)
        return spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def wanted(self, messages: DataFrame, reader: str, batch: int, starting: str = EARLIEST) -> DataFrame:
        """The ranges of a batch: as noted, or from where the reader's last batch ended to the log's end.

        A partition that the reader has not met begins at ``starting`` on its first batch, and
        at its earliest offset later.
        """
        mine = self.entries(messages.sparkSession).where(F.col("reader") == reader)
        noted = mine.where(F.col("batch") == batch).select(*PLACE, "start", "end").distinct()
        if not noted.isEmpty():
            return noted
        taken = mine.where(F.col("batch") < batch).groupBy(*PLACE).agg(F.max("end").alias("taken"))
        first = starting if mine.isEmpty() else EARLIEST
        found = ranges(messages, first).join(taken, PLACE, "left")
        return stage(found.select(*PLACE, F.coalesce("taken", "start").alias("start"), F.greatest("end", F.coalesce("taken", "end")).alias("end")), "wanted")

    def note(self, wanted: DataFrame, reader: str, batch: int) -> None:
        """Note a batch as taken; a batch noted before stays as it is."""
        spark = wanted.sparkSession
        known = self.entries(spark).where((F.col("reader") == reader) & (F.col("batch") == batch))
        if known.isEmpty():
            named = wanted.select(F.lit(reader).alias("reader"), F.lit(batch).cast("long").alias("batch"), *PLACE, "start", "end")
            named.coalesce(1).write.mode("append").parquet(self.path)  # a row for each topic partition

    def take(self, messages: DataFrame, reader: str, batch: int, starting: str = EARLIEST, whole: bool = True) -> tuple[DataFrame, DataFrame]:
        """The messages of a batch and its ranges; with ``whole``, lost offsets are an error."""
        wanted = self.wanted(messages, reader, batch, starting)
        if whole:
            check_whole(messages, wanted)
        return ranged(messages, wanted), wanted
