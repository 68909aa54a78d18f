"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import scratch_path
from tidemill.session import unstage as drop_staged  # noqa: F401  for the operators


def stage(frame: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write a table once and read it back: later steps, and tasks run again, start here."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    writer = frame.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def bounded(rows: DataFrame, number: int) -> DataFrame:
    """At most ``number`` rows of (doc_id, ...), the least by a hash of doc_id.

    Where there are more, rows above about the share wanted are left out first, so that no
    task offers more than its part of the sample.
    """
    place, total = F.xxhash64(F.col("doc_id").cast("long")), rows.count()
    if total > number:
        rows = rows.where(F.pmod(place, F.lit(1 << 40)) < ceil((1.2 * number / total) * (1 << 40)))
    return rows.orderBy(place, *[F.col(f"`{name}`") for name in rows.columns]).limit(number)


def freed(run: Callable) -> Callable:
    """``run`` of a mapInArrow, after which the worker gives back memory that it holds and does not
    use. Workers live on from task to task, and an executor has to hold all it ever gave them."""

    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, one table a group, from batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(key).to_numpy(zero_copy_only=False) for key in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1), batch.num_rows]
        if held and any(held[-1].column(key)[-1] != batch.column(key)[0] for key in keys):
            yield pa.Table.from_batches(held)
            held = []
        for first, end in zip(cuts[:-2], cuts[1:-1]):
            yield pa.Table.from_batches([*held, batch.slice(first, end - first)])
            held = []
        held.append(batch.slice(cuts[-2]))
    if held:
        yield pa.Table.from_batches(held)
