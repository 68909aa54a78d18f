"""From decoded rows to lake rows: typed times, then ingestion metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.catalog import DatasetSpec, Field
from tidemill.functions.temporal import epoch_days, epoch_millis, iso_timestamp

# The date pattern behind each partition folder.
PARTITION_PATTERNS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def add_ingestion_metadata(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Ingestion time and its zero-padded year, month, day and hour.

    The time is one constant per batch or micro-batch unless ``now`` is given.
    """
    stamped = rows.withColumn("_ingested_at", F.current_timestamp() if now is None else now)
    return stamped.withColumns(
        {
            name: F.date_format("_ingested_at", pattern)
            for name, pattern in PARTITION_PATTERNS.items()
        }
    )


def _converted(field: Field, whole_seconds: bool) -> Column:
    staged = F.col(field.staged_name)
    if field.kind == "epoch_ms":
        return epoch_millis(staged, whole_seconds)
    if field.kind == "epoch_days":
        return epoch_days(staged)
    if field.kind == "iso_ts":
        return iso_timestamp(staged)
    return staged


def convert_times(
    rows: DataFrame, spec: DatasetSpec, whole_seconds: bool = False
) -> DataFrame:
    """Wire times to timestamps and dates; the staged epoch columns are dropped."""
    names = {f.staged_name for f in spec.fields}
    head = [c for c in rows.columns if c not in names]
    return rows.select(
        *head, *[_converted(f, whole_seconds).alias(f.name) for f in spec.landed_fields()]
    )


def enrich(
    rows: DataFrame,
    spec: DatasetSpec,
    now: Column | None = None,
    whole_seconds: bool = False,
) -> DataFrame:
    """Decoded rows of any dataset, ready to land."""
    return add_ingestion_metadata(convert_times(rows, spec, whole_seconds), now)
