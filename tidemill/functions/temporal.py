"""Time conversions. All expect a UTC session; none fails on a bad wire value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# First and last millisecond of the years 1 to 9999.
MIN_MILLIS, MAX_MILLIS = -62135596800000, 253402300799999


def epoch_millis(millis: Column, whole_seconds: bool = False) -> Column:
    """Epoch millis as a timestamp, NULL outside the years 1 to 9999.

    ``whole_seconds`` cuts the millis off, towards zero, for readers that
    expect second precision.
    """
    kept = millis - millis % 1000 if whole_seconds else millis
    return F.when(millis.between(MIN_MILLIS, MAX_MILLIS), F.timestamp_millis(kept))


def epoch_days(days: Column) -> Column:
    """Epoch days as a date; NULL when the number is no day Spark can hold."""
    return F.date_from_unix_date(days.try_cast("int"))


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text as a timestamp, NULL when it is none."""
    return F.try_to_timestamp(text)


def lenient_timestamp(column: Column, data_type: str) -> Column:
    """Any column as a timestamp, bad values as NULL; timestamps pass through."""
    if data_type == "string":
        return F.try_to_timestamp(column)
    if data_type == "date":
        return column.cast("timestamp")
    return column


def to_epoch_millis(timestamp: Column) -> Column:
    return F.unix_millis(timestamp.cast("timestamp"))


def to_epoch_days(date: Column) -> Column:
    return F.unix_date(date.cast("date")).cast("bigint")


def to_iso(timestamp: Column) -> Column:
    """ISO text with a six-digit fraction, or none when it is zero."""
    whole = F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(timestamp, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", "").otherwise(fraction))


def whole_minutes(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, cut towards zero; NULL while either is missing."""
    return F.timestamp_diff("MINUTE", start, end)


def minute_label(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd HH:mm")


def month_tag(date: Column) -> Column:
    """``_YYYYMM``, the suffix of a campaign name."""
    return F.concat(F.lit("_"), F.date_format(date, "yyyyMM"))


def day_start(date: Column) -> Column:
    return date.cast("date").cast("timestamp")
