"""Constraint checks of the source tables. They report, and change nothing."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableRules:
    """Constraints of one table: keys, references, required columns, text and number sizes."""

    unique: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    money: tuple[str, ...] = ()


# The constraints of the source tables.
SOURCE_RULES = {
    "customers": TableRules(
        unique=("customer_id", "email"),
        max_length={
            "customer_id": 36,
            "first_name": 100,
            "last_name": 100,
            "email": 255,
            "phone": 50,
            "city": 100,
            "country": 100,
        },
    ),
    "products": TableRules(
        unique=("product_id",),
        max_length={"product_id": 36, "name": 255, "category": 100},
        money=("price", "cost"),
    ),
    "orders": TableRules(
        unique=("order_id",),
        references={"customer_id": ("customers", "customer_id")},
        max_length={"order_id": 36, "customer_id": 36, "status": 50},
        money=("total_amount",),
    ),
    "order_items": TableRules(
        unique=("order_item_id",),
        references={
            "order_id": ("orders", "order_id"),
            "product_id": ("products", "product_id"),
        },
        max_length={"order_item_id": 36, "order_id": 36, "product_id": 36},
        money=("unit_price", "total_price"),
    ),
    "payments": TableRules(
        unique=("payment_id",),
        references={"order_id": ("orders", "order_id")},
        required=("amount",),
        max_length={
            "payment_id": 36,
            "order_id": 36,
            "payment_method": 50,
            "status": 50,
            "transaction_id": 100,
        },
        money=("amount",),
    ),
    "incidents": TableRules(
        unique=("incident_id",),
        required=("title", "service", "start_time"),
        max_length={
            "incident_id": 36,
            "title": 255,
            "service": 100,
            "severity": 20,
            "status": 20,
        },
    ),
    "support_tickets": TableRules(
        unique=("ticket_id",),
        references={
            "customer_id": ("customers", "customer_id"),
            "order_id": ("orders", "order_id"),
        },
        max_length={
            "ticket_id": 36,
            "customer_id": 36,
            "order_id": 36,
            "subject": 255,
            "status": 50,
            "priority": 20,
            "assigned_to": 100,
        },
    ),
    "marketing_spend": TableRules(
        unique=("spend_id",),
        max_length={"spend_id": 36, "campaign_name": 255, "channel": 100, "currency": 3},
        money=("amount",),
    ),
}


def duplicate_keys(frame: DataFrame, *key: str) -> DataFrame:
    """Keys held by more than one row. NULL never equals NULL, so it is no duplicate."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    counts = frame.where(known).groupBy(*key).agg(F.count("*").alias("rows"))
    return counts.where("rows > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Referenced keys the parent lacks, with their number of child rows; NULL refers to nothing.

    Both sides meet in one aggregation, to which each task brings one row per key, however often
    it occurs: a key is held once, and nothing is sorted.
    """
    referred = child.select(column, F.lit(1).alias("rows"), F.lit(False).alias("__known"))
    known = parent.select(F.col(key).alias(column), F.lit(0).alias("rows"), F.lit(True).alias("__known"))
    keys = referred.unionAll(known).where(F.col(column).isNotNull()).groupBy(column)
    counts = keys.agg(F.sum("rows").alias("rows"), F.bool_or("__known").alias("__known"))
    return counts.where(~F.col("__known")).select(column, "rows")


def violations(frame: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows breaking each named rule (a SQL condition), all counted in one pass.

    An unbroken rule has 0.
    """
    counts = [F.count_if(F.expr(broken)).alias(f"rule_{i}") for i, broken in enumerate(rules.values())]
    cells = [cell for i, name in enumerate(rules) for cell in (F.lit(name), F.col(f"rule_{i}"))]
    return frame.agg(*counts).select(F.stack(F.lit(len(rules)), *cells).alias("rule", "rows"))


def missing(column: str) -> str:
    """The column must have a value."""
    return f"`{column}` IS NULL"


def too_long(column: str, limit: int) -> str:
    return f"length(`{column}`) > {int(limit)}"


def no_money(column: str) -> str:
    """The value does not fit a decimal(10,2)."""
    return f"`{column}` IS NOT NULL AND try_cast(`{column}` AS decimal(10,2)) IS NULL"


def table_violations(frame: DataFrame, rules: TableRules) -> DataFrame:
    """All row-level rules of a table: required columns (keys too), text sizes, money."""
    # The first unique column is the primary key, which is required as well.
    checks = {f"{c} is null": missing(c) for c in (*rules.unique[:1], *rules.required)}
    checks |= {f"{c} over {n} characters": too_long(c, n) for c, n in rules.max_length.items()}
    checks |= {f"{c} is no decimal(10,2)": no_money(c) for c in rules.money}
    return violations(frame, checks)
