"""Filters a report reader chooses: a recent window, and value lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.temporal import lenient_timestamp

# The window choices, in days, and the one chosen first.
WINDOW_CHOICES = {"All": None, "365 days": 365, "90 days": 90, "30 days": 30, "7 days": 7}
DEFAULT_WINDOW = "90 days"


def recent_days(frame: DataFrame, column: str, days: int | None) -> DataFrame:
    """Rows at most ``days`` older than the newest row of the frame itself.

    The cutoff is inclusive. Rows without a time are dropped, unless no row has
    one: then all are kept, as they are when ``days`` is None or the column is
    absent.

    The cutoff is a scalar subquery, whose value Spark hands to the Parquet
    reader: row groups before it are not read. Keeping the all-NULL case in a
    branch of its own is what makes that possible; this branch reads only row
    groups that hold NULL times.
    """
    if days is None or column not in frame.columns:
        return frame
    kind = dict(frame.dtypes)[column]
    # A date is compared as a date: a cast would hide the column from the reader.
    time = F.col(column) if kind == "date" else lenient_timestamp(F.col(column), kind)
    newest = F.max(time)
    cutoff = frame.agg((newest - F.expr(f"INTERVAL '{int(days)}' DAY")).alias("cutoff"))
    recent = frame.where(time >= cutoff.scalar())
    undated = frame.where(time.isNull() & cutoff.scalar().isNull())
    return recent.unionAll(undated)


def window_conditions(frame: DataFrame, column: str) -> dict[str, Column]:
    """For each window choice, whether a row is inside: ``recent_days`` as a condition.

    All share one scalar subquery, the newest time, so that one scan can serve them all.
    """
    kind = dict(frame.dtypes)[column]
    time = F.col(column) if kind == "date" else lenient_timestamp(F.col(column), kind)
    newest = frame.agg(F.max(time).alias("newest")).scalar()
    inside = {}
    for label, days in WINDOW_CHOICES.items():
        if days is None:
            inside[label] = F.lit(True)
        else:
            cutoff = newest - F.expr(f"INTERVAL '{int(days)}' DAY")
            inside[label] = F.coalesce(time >= cutoff, newest.isNull())
    return inside


def in_list(frame: DataFrame, column: str, selected: list[str] | None) -> DataFrame:
    """Rows whose value is selected; an empty selection or an absent column filters nothing."""
    if not selected or column not in frame.columns:
        return frame
    return frame.where(F.col(column).isin(*selected))


def options(frame: DataFrame, column: str) -> DataFrame:
    """The distinct values a reader can select from, sorted, NULL left out."""
    return frame.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def in_options(frame: DataFrame, column: str, offered_by: DataFrame | None = None) -> DataFrame:
    """The filter with every option selected: it drops only the rows without a value.

    Options are offered by the data before other filters (``offered_by``, else
    the frame itself). Where that has no value at all, nothing can be selected
    and nothing is dropped. A subquery tells, of which each task reads up to its
    first row with a value; no job runs before the result is asked for.
    """
    if column not in frame.columns:
        return frame
    source = frame if offered_by is None else offered_by
    any_value = source.where(F.col(column).isNotNull()).select(F.lit(True).alias("any")).limit(1)
    return frame.where(F.col(column).isNotNull() | any_value.scalar().isNull())


def with_lenient_time(frame: DataFrame, column: str, alias: str) -> DataFrame:
    """Add ``column`` as a timestamp, NULL where it is unreadable or the column is absent."""
    if column not in frame.columns:
        return frame.withColumn(alias, F.lit(None).cast("timestamp"))
    return frame.withColumn(alias, lenient_timestamp(F.col(column), dict(frame.dtypes)[column]))


def concat_frames(*frames: DataFrame) -> DataFrame:
    """All rows under the union of the columns, matched by name; missing ones are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
