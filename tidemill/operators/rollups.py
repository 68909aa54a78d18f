"""Figures from partial aggregates: counts, exact sums and distinct counts that can be put together.

Partial rows hold the count of their rows, the pieces of sums of money, and HyperLogLog sketches
of what is counted distinct. They are kept by the finest dimensions; any coarser figure comes
from them, and never from the rows again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import money

SKETCH_BITS = 12
"""Sketches of 2^12 registers are off by 1.6 percent, as a standard error."""


@dataclass(frozen=True)
class RollupSpec:
    """What is kept of a dataset: SQL expressions by name.

    ``dimensions`` are grouped by, ``amounts`` summed, ``distinct`` counted by sketches.
    """

    dimensions: dict[str, str]
    amounts: dict[str, str] = field(default_factory=dict)
    distinct: dict[str, str] = field(default_factory=dict)


def partials(rows: DataFrame, spec: RollupSpec) -> DataFrame:
    """One row for each value of the dimensions. A NULL is a value; it is not counted distinct."""
    kept = [F.count("*").alias("rows")]
    for name, said in spec.amounts.items():
        kept += [piece.alias(f"{name}_{part}") for part, piece in money.pieces(F.expr(said)).items()]
    for name, said in spec.distinct.items():
        kept.append(F.hll_sketch_agg(F.expr(said).cast("string"), SKETCH_BITS).alias(f"{name}_sketch"))
    return rows.groupBy(*[F.expr(said).alias(name) for name, said in spec.dimensions.items()]).agg(*kept)


def merged(kept: DataFrame, spec: RollupSpec, *by: str) -> DataFrame:
    """Figures by some of the dimensions: rows, sums of amounts, estimates of distinct counts."""
    figures = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    for name in spec.amounts:
        figures.append(money.assembled(money.regathered(f"{name}_")).alias(name))
    for name in spec.distinct:
        union = F.hll_sketch_estimate(F.hll_union_agg(f"{name}_sketch"))
        figures.append(F.coalesce(union, F.lit(0)).alias(name))
    return kept.groupBy(*by).agg(*figures)
