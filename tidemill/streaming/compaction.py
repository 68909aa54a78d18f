"""Small files of a lake rewritten as few sorted ones, without a moment in which rows are missing or double.

The lake's own folder stays as it is, whoever writes to it. Rewritten files are in a folder beside
it, one for each compaction, and a ledger says which of the lake's files each one stands
for. A reader takes the files that no compaction stands for, and the compactions the ledger names: the
one file that the ledger gains is the switch.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.catalog import PARTITION_COLUMNS
from tidemill.session import remove
from tidemill.sources.lake import exists, list_files

LEDGER_SCHEMA = "file string, version string"

# Bytes of small files whose rows one task sorts: in memory they take about thirty times that.
SORTED_BYTES = 16 << 20


@dataclass(frozen=True)
class CompactedLake:
    """A dataset's folder ``lake`` and its compactions in ``path``. One compaction at a time."""

    lake: str
    path: str
    schema: T.StructType
    """The dataset's columns with those of its ingestion hour."""
    target_bytes: int = 256 << 20
    crowded: int = 8
    """Files in an hour's folder that are worth a compaction, if half of ``target_bytes`` holds each."""
    files_at_once: int = 10_000

    @property
    def ledger(self) -> str:
        return f"{self.path.rstrip('/')}/ledger"

    def folder(self, version: str) -> str:
        return f"{self.path.rstrip('/')}/data/{version}"

    def entries(self, spark: SparkSession) -> DataFrame:
        """(file, version) of every file of the lake that a compaction stands for."""
        if not exists(spark, self.ledger):
            return spark.createDataFrame([], LEDGER_SCHEMA)
        return spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger)

    def loose(self, spark: SparkSession) -> DataFrame:
        """(path, modificationTime, length) of the lake's other files."""
        done = self.entries(spark).select(F.col("file").alias("path"))
        return list_files(spark, self.lake).join(done, "path", "left_anti")

    def small(self, spark: SparkSession) -> DataFrame:
        """(path, length) of small files in the folders that hold many."""
        hour = F.regexp_replace("path", "/[^/]*$", "").alias("hour")
        files = self.loose(spark).where(F.col("length") < self.target_bytes / 2).select("path", "length", hour)
        many = files.groupBy("hour").agg(F.count("*").alias("files")).where(F.col("files") >= self.crowded)
        return files.join(many, "hour", "left_semi").select("path", "length")

    def compact(self, spark: SparkSession, *sort_by: str) -> int:
        """Rewrite the small files of crowded hours, sorted by hour and then ``sort_by``; how many there were.

        Rows are dealt to files by ranges of that order, so that an hour of any size takes as
        many files as its rows fill, and no task sorts more than ``SORTED_BYTES``. An attempt that
        fails is in no ledger.
        """
        files = self.small(spark).orderBy("path").limit(self.files_at_once).collect()
        if not files:
            return 0
        version, order = uuid.uuid4().hex, [*PARTITION_COLUMNS, *sort_by]
        paths = [row.path for row in files]
        rows = spark.read.schema(self.schema).option("basePath", self.lake).parquet(*paths)
        parts = max(1, ceil(sum(row.length for row in files) / min(self.target_bytes, SORTED_BYTES)))
        dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        dealt.write.partitionBy(*PARTITION_COLUMNS).parquet(self.folder(version))
        named = spark.createDataFrame([(path, version) for path in paths], LEDGER_SCHEMA)
        named.coalesce(1).write.mode("append").parquet(self.ledger)
        return len(paths)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The dataset as it is now; each row once."""
        # One ledger for both halves: a switch in between is seen by neither.
        entries = self.entries(spark).collect()  # one short row for each file rewritten
        replaced = spark.createDataFrame([(row.file,) for row in entries], "path string")
        loose = [row.path for row in list_files(spark, self.lake).join(replaced, "path", "left_anti").select("path").collect()]
        parts = []
        if loose:
            parts.append(spark.read.schema(self.schema).option("basePath", self.lake).parquet(*loose))
        for version in sorted({row.version for row in entries}):
            parts.append(spark.read.schema(self.schema).parquet(self.folder(version)))
        found = spark.createDataFrame([], self.schema)
        for part in parts:
            found = found.unionByName(part.select(*self.schema.fieldNames()))
        return found

    def vacuum(self, spark: SparkSession) -> int:
        """Delete folders of attempts that no ledger names; how many there were.

        Not while a compaction runs. Files of the lake are its writer's to delete.
        """
        root = f"{self.path.rstrip('/')}/data"
        if not exists(spark, root):
            return 0
        known = {row.version for row in self.entries(spark).select("version").distinct().collect()}
        found = list_files(spark, root).select(F.regexp_extract("path", "/data/([0-9a-f]{32})/", 1).alias("version")).distinct()
        stray = [row.version for row in found.collect() if row.version not in known]
        for version in stray:
            remove(spark, self.folder(version))
        return len(stray)
