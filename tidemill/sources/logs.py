"""Message logs: Kafka, or files in the shape of a Kafka read."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tidemill.sources import offsets
from tidemill.sources.lake import has_data

# Where a reader without a checkpoint starts.
BACKFILL_OFFSETS = "earliest"
FOLLOW_OFFSETS = "latest"
AUDIT_OFFSETS = "latest"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
        T.StructField("topic", T.StringType()),
    ]
)


ENDS_SCHEMA = "topic string, partition int, first long, end long"


def table_topics(prefix: str, but_not: Iterable[str] = ()) -> str:
    """Pattern of every table topic under a connector prefix.

    Tables in ``but_not`` are ruled out by the pattern, so their messages are never fetched.
    """
    ruled_out = "|".join(re.escape(table) + "$" for table in but_not)
    return re.escape(prefix) + r"\.public\." + (f"(?!{ruled_out})" if ruled_out else "") + ".*"


@dataclass(frozen=True)
class KafkaLog:
    """Topics on a Kafka cluster.

    ``options`` go to every reader. A reader fails when offsets it wants have aged out;
    ``failOnDataLoss`` "false" goes on without them. At scale set ``minPartitions``, which splits
    a topic partition that holds much of the data among tasks, and
    ``maxOffsetsPerTrigger``, which bounds a micro-batch of a backfill.
    """

    servers: str
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self, starting: str, **choice: str) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "startingOffsets": starting,
            "failOnDataLoss": "true",
            **choice,
            **self.options,
        }

    def read(
        self,
        spark: SparkSession,
        topic: str,
        starting: str = BACKFILL_OFFSETS,
        ending: str = FOLLOW_OFFSETS,
    ) -> DataFrame:
        """One topic as it is now, between two positions: names or offsets as JSON."""
        chosen = self.reader_options(starting, subscribe=topic, endingOffsets=ending)
        return spark.read.format("kafka").options(**chosen).load()

    def stream(
        self, spark: SparkSession, topic: str, starting: str = FOLLOW_OFFSETS
    ) -> DataFrame:
        """One topic as it grows."""
        chosen = self.reader_options(starting, subscribe=topic)
        return spark.readStream.format("kafka").options(**chosen).load()

    def stream_matching(
        self, spark: SparkSession, pattern: str, starting: str = AUDIT_OFFSETS
    ) -> DataFrame:
        """All topics matching a pattern, new ones included."""
        chosen = self.reader_options(starting, subscribePattern=pattern)
        return spark.readStream.format("kafka").options(**chosen).load()


@dataclass(frozen=True)
class FileLog:
    """Parquet files of log rows, one folder per topic.

    A replay of a log, or a stand-in for one. ``append`` numbers messages that have no
    offsets, in ``partitions`` partitions of each topic; one writer at a time. The topic is
    the folder, so reading one topic opens no file of another.
    """

    path: str
    max_files_per_trigger: int | None = None
    partitions: int = 1

    def messages(self, spark: SparkSession, topic: str | None = None) -> DataFrame:
        """All that the log holds, or what it holds of a topic."""
        rows = spark.read.schema(LOG_SCHEMA).parquet(self.path)
        return rows if topic is None else rows.where(F.col("topic") == topic)

    def read(
        self,
        spark: SparkSession,
        topic: str,
        starting: str = BACKFILL_OFFSETS,
        ending: str = FOLLOW_OFFSETS,
    ) -> DataFrame:
        rows = self.messages(spark, topic)
        if (starting, ending) == (BACKFILL_OFFSETS, FOLLOW_OFFSETS):
            return rows
        return offsets.ranged(rows, offsets.ranges(rows, starting, ending))

    def stream(
        self, spark: SparkSession, topic: str, starting: str = FOLLOW_OFFSETS
    ) -> DataFrame:
        # A glob for exactly this folder: unlike a plain path it need not exist yet.
        folder = f"{self.path}/topic={topic[:-1]}[{topic[-1]}]"
        columns = T.StructType([f for f in LOG_SCHEMA if f.name != "topic"])
        messages = self._stream_reader(spark).schema(columns).parquet(folder)
        messages = messages.withColumn("topic", F.lit(topic))
        return self._from(spark, messages, starting, F.col("topic") == topic)

    def stream_matching(
        self, spark: SparkSession, pattern: str, starting: str = AUDIT_OFFSETS
    ) -> DataFrame:
        messages = self._stream_reader(spark).schema(LOG_SCHEMA).parquet(self.path)
        matching = F.col("topic").rlike(f"^(?:{pattern})$")
        return self._from(spark, messages, starting, matching).where(matching)

    def _from(
        self, spark: SparkSession, messages: DataFrame, starting: str, topics: Column
    ) -> DataFrame:
        """A stream's messages from a position on, as the log is when the stream is made.

        The marks are one number for each topic partition. Partitions that come later are
        taken whole.
        """
        if starting == BACKFILL_OFFSETS or not has_data(spark, self.path):
            return messages
        known = offsets.marks(self.messages(spark).where(topics))
        begin = offsets.positions(known, starting, "start").collect()
        if any(row.start is None for row in begin):
            raise ValueError("messages without offsets: the log has no end to follow from")
        if not begin:
            return messages
        place = lambda topic, partition: F.concat_ws("/", topic, partition)
        marks = F.create_map(
            *chain.from_iterable((F.lit(f"{r.topic}/{r.partition}"), F.lit(r.start)) for r in begin)
        )
        mark = F.try_element_at(marks, place(F.col("topic"), F.col("partition").cast("string")))
        return messages.where(mark.isNull() | (F.col("offset") >= mark))

    def append(self, messages: DataFrame) -> None:
        """Add log rows: any of the log columns, ``topic`` and ``key`` among them.

        Rows that bring offsets keep them.
        """
        if "offset" not in messages.columns:
            spark = messages.sparkSession
            held = self.messages(spark) if has_data(spark, self.path) else None
            ends = offsets.marks(held) if held else spark.createDataFrame([], ENDS_SCHEMA)
            messages = offsets.numbered(messages, ends, self.partitions)
        messages.write.mode("append").partitionBy("topic").parquet(self.path)

    def _stream_reader(self, spark: SparkSession) -> DataStreamReader:
        reader = spark.readStream
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return reader
