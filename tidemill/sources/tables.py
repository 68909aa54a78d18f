"""Source tables: column lists, JDBC reads and emptiness."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog import DatasetSpec

HEX_DIGITS = "0123456789abcdef"


def fetch(table: DataFrame, spec_or_columns: DatasetSpec | list[str]) -> DataFrame:
    """The table cut to the given columns, or to those of a dataset."""
    if isinstance(spec_or_columns, DatasetSpec):
        spec_or_columns = [f.name for f in spec_or_columns.fields]
    return table.select(*spec_or_columns)


def key_ranges(key: str, digits: int = 1) -> list[str]:
    """Predicates that split a table by the first ``digits`` hex digits of its UUID key.

    There are 16 to the power of ``digits``, each a range of the key, which an index on it
    serves. Ranges have no gaps: keys that are no UUIDs, NULL included, fall into some
    range too, so no row is lost. The database must sort digits before letters.
    """
    starts = ["".join(p) for p in product(HEX_DIGITS, repeat=digits)]
    inner = [f"{key} >= '{low}' AND {key} < '{high}'" for low, high in zip(starts[1:], starts[2:])]
    first = f"{key} < '{starts[1]}' OR {key} IS NULL"
    return [first, *inner, f"{key} >= '{starts[-1]}'"]


def jdbc_table(
    spark: SparkSession,
    url: str,
    spec: DatasetSpec,
    predicates: list[str] | None = None,
    digits: int = 1,
    **properties: str,
) -> DataFrame:
    """A source table over JDBC, one connection per predicate, only the dataset's columns.

    ``predicates`` defaults to ``key_ranges`` of so many ``digits``: 2 make 256 splits, 3
    make 4,096. The column list reaches the database.
    """
    table = spark.read.jdbc(
        url,
        spec.name,
        predicates=predicates or key_ranges(spec.key, digits),
        properties={"fetchsize": "10000", **properties},
    )
    return fetch(table, spec)


def has_rows(table: DataFrame) -> bool:
    """Whether the table has a row; reads no further than the first."""
    return not table.isEmpty()


def presence(table: DataFrame, name: str) -> DataFrame:
    """``has_rows`` as a row of a report."""
    return table.limit(1).agg(
        F.lit(name).alias("dataset"), (F.count("*") > 0).alias("has_rows")
    )
