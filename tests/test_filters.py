import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plans import scanned_rows
from tidemill.operators import filters

TIMES = [
    dt.datetime(2024, 1, 10),
    dt.datetime(2024, 1, 3),
    dt.datetime(2024, 1, 2, 23, 59, 59),
    None,
]


def frame_of(spark, times, kind="timestamp"):
    return spark.createDataFrame([(t,) for t in times], f"t {kind}")


def kept(frame):
    return sorted((r.t for r in frame.collect()), key=repr)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_window_is_inclusive_and_drops_undated(spark, kind):
    assert kept(filters.recent_days(frame_of(spark, TIMES, kind), "t", 7)) == sorted(
        TIMES[:2], key=repr
    )


def test_window_over_text_and_dates(spark):
    text = frame_of(spark, TIMES).select(F.col("t").cast("string"))
    bad = spark.createDataFrame([("soon",)], "t string")
    assert filters.recent_days(text.union(bad), "t", 7).count() == 2
    dates = frame_of(spark, [t and t.date() for t in TIMES], "date")
    expected = {dt.date(2024, 1, 10), dt.date(2024, 1, 3)}
    assert set(kept(filters.recent_days(dates, "t", 7))) == expected


def test_window_that_filters_nothing(spark):
    frame = frame_of(spark, TIMES)
    assert filters.recent_days(frame, "t", None) is frame
    assert filters.recent_days(frame, "absent", 7) is frame
    undated = frame_of(spark, [None, None])
    assert filters.recent_days(undated, "t", 7).count() == 2
    assert filters.recent_days(undated.limit(0), "t", 7).count() == 0


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.datetimes(dt.datetime(1990, 1, 1), dt.datetime(2030, 1, 1)), min_size=1, max_size=20
    ),
    st.integers(0, 400),
)
def test_newest_row_survives_every_window(spark, times, days):
    rows = kept(filters.recent_days(frame_of(spark, times), "t", days))
    cutoff = max(times) - dt.timedelta(days=days)
    assert rows == sorted((t for t in times if t >= cutoff), key=repr)


@pytest.mark.parametrize("kind", ["timestamp", "date"])
def test_window_skips_old_row_groups(spark, tmp_path, kind):
    day = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).cast(kind)
    path = str(tmp_path / "t")
    days = spark.range(40).crossJoin(spark.range(5000).select(F.uuid().alias("x")))
    days.select(day.alias("t"), "x").coalesce(1).sortWithinPartitions("t").write.option(
        "parquet.block.size", 1 << 18
    ).parquet(path)
    groups = pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).num_row_groups
    assert groups > 10
    recent = filters.recent_days(spark.read.parquet(path), "t", 3).select("x")
    result = recent.collect()
    assert len(result) == 4 * 5000
    assert sum(scanned_rows(recent)) < 200_000 / 4


def test_lists_and_options(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    assert filters.in_list(frame, "k", ["a"]).count() == 2
    assert filters.in_list(frame, "k", []) is frame
    assert filters.in_list(frame, "absent", ["a"]) is frame
    assert [r.k for r in filters.options(frame, "k").collect()] == ["a", "b"]
    assert filters.in_options(frame, "k").count() == 3
    assert filters.in_options(frame, "absent") is frame
    # Without any option nothing is dropped; options come from the unfiltered data.
    without = frame.where("k IS NULL")
    assert filters.in_options(without, "k").count() == 1
    assert filters.in_options(without, "k", offered_by=frame).count() == 0


def test_lenient_times_and_concat(spark):
    frame = spark.createDataFrame([("2024-01-02",), ("x",)], "a string")
    timed = filters.with_lenient_time(frame, "a", "t")
    timed = filters.with_lenient_time(timed, "absent", "u")
    assert sorted(map(tuple, timed.collect())) == [
        ("2024-01-02", dt.datetime(2024, 1, 2), None), ("x", None, None),
    ]
    other = spark.createDataFrame([(1, "y")], "b int, a string")
    both = filters.concat_frames(frame, other)
    assert both.columns == ["a", "b"]
    assert sorted(map(tuple, both.collect())) == [("2024-01-02", None), ("x", None), ("y", 1)]
