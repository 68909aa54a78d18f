"""Payments that follow their orders, as both streams come in."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemill.operators.rules import payment_lag

LATENESS = "1 hour"


def payment_lag_stream(
    payments: DataFrame, orders: DataFrame, within_minutes: int = 60, lateness: str = LATENESS
) -> DataFrame:
    """``payment_lag`` of two streams, each pair given out once, when the later row comes.

    Rows may come up to ``lateness`` after later ones of their stream; rows beyond that are
    dropped. An order waits until no payment within its time can come any more, and a
    payment until its order cannot, so that what is held follows the rows of ``lateness`` and
    ``within_minutes``, not the length of the streams. The slower stream's clock counts.
    """
    paid = payments.withWatermark("created_at", lateness)
    placed = orders.withWatermark("order_date", lateness)
    return payment_lag(paid, placed, within_minutes)
