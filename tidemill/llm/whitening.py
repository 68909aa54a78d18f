"""Whitening by a pivoted Cholesky factor and one-sided Jacobi rotations.

Vectors become whole numbers, each distinct one is on the fit list once, and Spark sums
means and the centred scatter of the list. What reaches the driver has the size of one
scatter matrix, whatever the table: it is factored with pivoting, and pairs of columns of
the triangular factor are rotated until all are orthogonal. The squares of their norms are
the eigenvalues of the scatter, the columns brought to length one its eigenvectors, so
that the scatter is never squared or multiplied again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.store import stage
from tidemill.llm.vectors import finite, matrix


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    """A unit of the vectors in whole steps."""
    components: int = 4
    sweeps: int = 60
    """Rounds over all pairs of columns after which the factor should long be orthogonal."""


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
MOST_BITS = 1 << 63


def whole(rows: DataFrame, settings: Settings) -> DataFrame:
    """(vec_id, x) with x = floor(scale * c) of each entry; beyond a long, the nearest long."""
    return rows.select("vec_id", F.transform("vector", lambda c: F.floor(c * settings.scale)).alias("x"))


def summed(rows: DataFrame, length: int, work) -> np.ndarray:
    """Sum over all batches of the matrix that ``work`` makes of a batch.

    Each task adds its batches up and returns its matrix by lines; lines meet by number, and
    the driver receives one matrix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = work(matrix(batch.column(0), length))
                total = part if total is None else total + part
        for line, values in enumerate([] if total is None else total):
            yield pa.RecordBatch.from_arrays([pa.array([line], pa.int32()), pa.array([values])], ["line", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for line, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.array(part.values)
                totals[line] = totals[line] + values if line in totals else values
        for line, values in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([line], pa.int32()), pa.array([values])], ["line", "part"])

    kind = "line int, part array<double>"
    lines = rows.select("x").mapInArrow(run, kind).repartition("line").mapInArrow(add, kind).collect()
    return np.array([row.part for row in sorted(lines, key=lambda row: row.line)])


def totals(fit: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums of each entry: whole numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * length
        for batch in batches:
            x = matrix(batch.column(0), length)
            most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
            added = x.sum(0) if most * len(x) < MOST_BITS else x.astype(object).sum(0)
            n, sums = n + len(x), [a + int(b) for a, b in zip(sums, added)]
        columns = [pa.array(range(length), pa.int32()), pa.array([n] * length, pa.int64()), pa.array(list(map(Decimal, sums)), pa.decimal128(38))]
        yield pa.RecordBatch.from_arrays(columns, ["place", "n", "total"])

    parts = fit.select("x").mapInArrow(run, "place int, n long, total decimal(38,0)")
    rows = parts.groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("place").collect()
    return (rows[0].n, [int(row.total) for row in rows]) if rows else (0, [0] * length)


def factored(scatter: np.ndarray) -> np.ndarray:
    """L with L L' = scatter, by lines of the scatter: each step takes the greatest diagonal
    entry left as pivot; entries lost in rounding end it, so that L has rank columns."""
    left, rest = scatter.copy(), np.diag(scatter).copy()
    least = len(scatter) * np.finfo(float).eps * max(rest.max(initial=0.0), 0.0)
    columns: list[np.ndarray] = []
    open_lines = np.ones(len(scatter), bool)
    while open_lines.any():
        pivot = int(np.where(open_lines, rest, -np.inf).argmax())
        if not rest[pivot] > least:
            break
        column = np.where(open_lines, left[:, pivot], 0.0) / np.sqrt(rest[pivot])
        column[pivot] = np.sqrt(rest[pivot])
        columns.append(column)
        open_lines[pivot] = False
        left -= np.outer(column, column)
        rest = np.diag(left).copy()
    return np.array(columns).T.reshape(len(scatter), len(columns))


def rounds(count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``count`` columns in rounds of pairs that share none, as in a tournament."""
    seats = list(range(count + count % 2))
    found = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], seats[:half - 1:-1]) if max(a, b) < count]
        found.append((np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return found


def rotated(factor: np.ndarray, sweeps: int) -> np.ndarray:
    """The factor's columns turned in pairs until each two are orthogonal."""
    lines = factor.T.copy()
    close = np.finfo(float).eps * max(4.0, np.sqrt(len(lines)))
    for _ in range(sweeps):
        worst = 0.0
        for a, b in rounds(len(lines)):
            left, right = lines[a], lines[b]
            alpha, beta, gamma = (np.einsum("ij,ij->i", x, y) for x, y in ((left, left), (right, right), (left, right)))
            off = np.abs(gamma) / np.sqrt(np.maximum(alpha * beta, np.finfo(float).tiny))
            worst = max(worst, off.max(initial=0.0))
            turn = off > close
            zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = (1 / np.hypot(1.0, t))[:, None]
            s = c * t[:, None]
            left, right = left[turn], right[turn]
            lines[a[turn]], lines[b[turn]] = c * left - s * right, s * left + c * right
        if worst <= close:
            return lines.T
    raise ValueError(f"columns are still not orthogonal after {sweeps} sweeps: {worst}")


def eigen(covariance: np.ndarray, sweeps: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; of rank many."""
    turned = rotated(factored(covariance), sweeps)
    norms = np.linalg.norm(turned, axis=0)
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, turned[:, order] / norms[order]


@dataclass
class Fit:
    """What the fit list says of all rows."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, each entry rounded once where n * x - S fits a long."""
        if self.fits(x):
            return (self.n * x - np.array(self.sums, np.int64)) / self.n
        return np.array([[(self.n * int(c) - s) / self.n for c, s in zip(row, self.sums)] for row in x]).reshape(x.shape)

    def fits(self, x: np.ndarray, power: int = 1) -> bool:
        """Whether sums of (n * x - S) ** power over a row stay within a long."""
        most = max(int(x.max(initial=0)), -int(x.min(initial=0))) * self.n + max(map(abs, self.sums), default=0)
        return most**power * x.shape[1] < MOST_BITS

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n * x - S) ** 2 of each row; null where it does not fit a long."""
        if self.fits(x, 2):
            return (((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(1)).tolist()
        found = [sum((self.n * int(c) - s) ** 2 for c, s in zip(row, self.sums)) for row in x]
        return [value if value < MOST_BITS else None for value in found]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def fitted(fit: DataFrame, length: int, settings: Settings = Settings()) -> Fit:
    """The first components of the distinct rows (x): covariance with divisor n, centred first."""
    n, sums = totals(fit, length)
    found = Fit(n, sums, np.zeros(0), np.zeros((length, 0)), 0.0)
    if not n:
        return found

    def scatter(x: np.ndarray) -> np.ndarray:
        centred = found.centred(x)
        return centred.T @ centred

    covariance = summed(fit, length, scatter) / n
    found.trace = float(np.trace(covariance))
    values, vectors = eigen(covariance, settings.sweeps)
    found.values, found.vectors = values[: settings.components], vectors[:, : settings.components]
    return found


def whitened(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Each row of (vec_id, embedding, ...) on each of the first components.

    Returns vec_id, component (from 1), n, deviation, whitened, explained and
    identity_error as the contract of the query names them. Left out are rows whose vector is
    null, empty, holds a null, NaN or infinity, or is not of the table's commonest length.
    Rows may repeat and may have no vec_id: each has its own result. A component without
    variance is left out, as no scale whitens it: a table of one distinct vector gives no
    rows. ``deviation`` is null where it is beyond a long.
    """
    rows, length = finite(table)
    length = max(1, length)
    numbers = whole(rows, settings)
    fit = stage(numbers.select("x").distinct(), "fit")
    model = fitted(fit, length, settings)
    count = len(model.values)
    if count:
        # Of the whitened fit list: its own mean is taken off before it is multiplied.
        mean = summed(fit, length, lambda x: model.whitened(x).sum(0, keepdims=True))[0] / model.n

        def products(x: np.ndarray) -> np.ndarray:
            centred = model.whitened(x) - mean
            return centred.T @ centred

        error = float(np.abs(summed(fit, length, products) / model.n - np.eye(count)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), length)
            if not count or not len(x):
                continue
            each = lambda values: np.tile(values, len(x))
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), count))),
                pa.array(each(np.arange(1, count + 1, dtype=np.int32))),
                pa.array(np.full(len(x) * count, model.n, np.int64)),
                pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), count))),
                pa.array(model.whitened(x).ravel()),
                pa.array(each(model.values / model.trace)),
                pa.array(np.full(len(x) * count, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in OUT.split(", ")])

    return numbers.mapInArrow(run, OUT)
