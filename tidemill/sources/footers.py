"""Row counts from Parquet footers: no column of any file is read.

Spark's newer file reader answers counts from footers when told to. The settings for that
hold for a whole session, so counts are made in a session of their own, which shares
the executors and nothing else. Minima and maxima are not asked for: that reader looks
columns up by their place in the given schema, which is wrong where files differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog import PARTITION_COLUMNS
from tidemill.session import configure, scratch_path
from tidemill.sources.lake import has_data

FROM_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose counts come from footers."""
    session = configure(spark.newSession())
    for key, value in FROM_FOOTERS.items():
        session.conf.set(key, value)
    return session


def hourly_counts(session: SparkSession, root: str) -> DataFrame:
    """(year, month, day, hour, rows) of a lake folder, in a ``footer_session``."""
    rows = session.read.parquet(root)
    return rows.groupBy(*PARTITION_COLUMNS).agg(F.count("*").alias("rows"))


def rows_by_hour(spark: SparkSession, root: str) -> DataFrame:
    """Rows of each ingestion hour of a dataset's folder; none where nothing has landed."""
    kinds = ", ".join(f"{name} string" for name in PARTITION_COLUMNS)
    if not has_data(spark, root):
        return spark.createDataFrame([], f"{kinds}, rows long")
    path = scratch_path(spark, "counts")
    hourly_counts(footer_session(spark), root).write.parquet(path)
    return spark.read.schema(f"{kinds}, rows long").parquet(path)


def row_count(spark: SparkSession, root: str) -> int:
    """All rows of a dataset's folder."""
    return rows_by_hour(spark, root).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
