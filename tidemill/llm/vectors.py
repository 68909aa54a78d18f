"""Vectors that operators can work on, and their batches as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LARGEST = float(np.finfo(np.float64).max)


def finite(table: DataFrame, name: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id long, vector array<double>) of the rows whose vector can be worked on, and its length.

    Left out are vectors that are null, empty, or hold a null, NaN or infinity, and those
    whose length is not the table's commonest (of equally common ones the greatest): they
    live in no space with the others. Rows may repeat; other columns are not read. With no
    row left the length is 0.
    """
    rows = table.select(F.col("vec_id").cast("long"), F.col(name).cast("array<double>").alias("vector"))
    whole = rows.where(F.size("vector") > 0).where(
        F.forall("vector", lambda c: F.coalesce(F.abs(c) <= LARGEST, F.lit(False)))
    )
    length = F.size("vector")
    commonest = whole.groupBy(length.alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return whole.where(length == (commonest.n if commonest else 0)), commonest.n if commonest else 0


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """A list column of vectors without nulls, one row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
