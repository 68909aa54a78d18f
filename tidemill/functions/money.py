"""Money: doubles in the lake, whole cents while they are added up, text in reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cents are added up in two parts of this many bits and more. The low parts of 2^43 rows fit
# a bigint, as do the high parts of as many amounts of a decimal(10,2) column; where the high
# parts of larger amounts run over, and for amounts beyond ``LARGEST``, doubles are added up.
LOW_BITS = 20
LARGEST = 9e16


def cents(amount: Column) -> Column:
    """A double amount in whole cents; NULL for NaN and what no bigint of cents can hold."""
    return F.when(F.abs(amount) < LARGEST, F.rint(amount * 100).cast("bigint"))


def present(amount: Column) -> Column:
    """The amount, NULL for NaN."""
    return F.when(~F.isnan(amount), amount)


def pieces(amount: Column) -> dict[str, Column]:
    """What ``total`` adds up, as aggregates that can be kept and put together later."""
    whole, known = cents(amount), present(amount)
    return {
        "high": F.try_sum(F.shiftright(whole, LOW_BITS)),
        "low": F.sum(whole.bitwiseAND(F.lit((1 << LOW_BITS) - 1))),
        "doubles": F.sum(known),
        "most": F.max(F.abs(known)),
    }


def regathered(prefix: str) -> dict[str, Column]:
    """Aggregates over kept ``pieces``, whose columns begin with a prefix: again pieces.

    A high part that had run over is NULL beside an amount, and makes the sum one of doubles.
    """
    part = lambda name: F.col(f"{prefix}{name}")
    run_over = F.coalesce(F.bool_or(part("high").isNull() & part("most").isNotNull()), F.lit(False))
    return {
        "high": F.when(~run_over, F.try_sum(part("high"))),
        "low": F.sum(part("low")),
        "doubles": F.sum(part("doubles")),
        "most": F.max(part("most")),
    }


def assembled(found: dict[str, Column]) -> Column:
    """The sum that pieces make; 0.0 where there is nothing to add."""
    high, low = found["high"].cast("decimal(20,0)"), found["low"].cast("decimal(20,0)")
    both = (high * F.lit(Decimal(1 << LOW_BITS)) + low) * F.lit(Decimal("0.01"))
    exact = F.when(found["most"] < LARGEST, both.cast("double"))
    return F.coalesce(exact, found["doubles"], F.lit(0.0))


def total(amount: Column) -> Column:
    """Exact sum as a double, whatever the order of rows; 0.0 when there is nothing to add.

    Two bigint sums cost a fifth of one decimal sum. Where an amount is too large for
    them, infinities included, or the amounts together are, they are added up as doubles.
    NaN is missing.
    """
    return assembled(pieces(amount))


def mean(amount: Column) -> Column:
    """Mean of the amounts there are; 0.0 when there are none."""
    return F.coalesce(F.try_divide(total(amount), F.count(present(amount))), F.lit(0.0))


def same(left: Column, right: Column) -> Column:
    """Whether two amounts agree to the cent; beyond whole cents, whether they are equal."""
    both = cents(left).isNotNull() & cents(right).isNotNull()
    return F.when(both, cents(left) == cents(right)).otherwise(
        present(left).eqNullSafe(present(right))
    )


def line_total(quantity: Column, unit_price: Column) -> Column:
    """Quantity times price, in whole cents."""
    return F.rint(quantity * unit_price * 100) / 100


def format_count(value: Column) -> Column:
    """``1,234``"""
    return F.format_number(value, 0)


def format_percent(value: Column) -> Column:
    """``66.7%``"""
    return F.concat(F.format_number(value, 1), F.lit("%"))


def format_currency(value: Column) -> Column:
    """``$1,234.56``; a minus sign follows the dollar sign."""
    return F.concat(F.lit("$"), F.format_number(value, 2))
