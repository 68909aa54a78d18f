"""Rollups that follow a lake: a refresh reads only files that have landed since the last one.

Each refresh writes its partial rows to a folder of their own, then notes in a ledger which
files they are of. Only folders that the ledger names count, so a refresh that failed
leaves nothing behind, and no file is counted twice.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.rollups import RollupSpec, merged, partials
from tidemill.sources.lake import exists, list_files

LEDGER_SCHEMA = "file string, part string"


@dataclass(frozen=True)
class RollupTable:
    """Partial rows of the dataset in ``lake``, kept in ``path``. One refresh at a time."""

    path: str
    lake: str
    schema: T.StructType
    spec: RollupSpec
    files_at_once: int = 10_000
    """Files whose names the driver holds at a time."""

    @property
    def ledger(self) -> str:
        return f"{self.path.rstrip('/')}/ledger"

    def entries(self, spark: SparkSession) -> DataFrame:
        """(file, part) of every file that has been counted."""
        if not exists(spark, self.ledger):
            return spark.createDataFrame([], LEDGER_SCHEMA)
        return spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger)

    def fresh(self, spark: SparkSession) -> DataFrame:
        """Files of the lake that have not been counted."""
        known = self.entries(spark).select(F.col("file").alias("path"))
        return list_files(spark, self.lake).join(known, "path", "left_anti")

    def refresh(self, spark: SparkSession) -> int:
        """Count the files that are new; how many there were."""
        taken = 0
        while files := [row.path for row in self.fresh(spark).orderBy("path").limit(self.files_at_once).collect()]:
            part = uuid.uuid4().hex
            rows = spark.read.schema(self.schema).option("basePath", self.lake).parquet(*files)
            partials(rows, self.spec).write.parquet(f"{self.path.rstrip('/')}/parts/{part}")
            named = spark.createDataFrame([(file, part) for file in files], LEDGER_SCHEMA)
            named.coalesce(1).write.mode("append").parquet(self.ledger)
            taken += len(files)
        return taken

    def kept(self, spark: SparkSession) -> DataFrame:
        """All partial rows."""
        # One name for each refresh and ``files_at_once`` files.
        parts = [row.part for row in self.entries(spark).select("part").distinct().collect()]
        if parts:
            return spark.read.parquet(*[f"{self.path.rstrip('/')}/parts/{part}" for part in sorted(parts)])
        return partials(spark.createDataFrame([], self.schema), self.spec)

    def figures(self, spark: SparkSession, *by: str) -> DataFrame:
        """Figures by some of the dimensions, of all that has been counted."""
        return merged(self.kept(spark), self.spec, *by)
