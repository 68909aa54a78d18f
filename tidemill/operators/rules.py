"""Set-level rules of the shop: totals, lookups, lags and session order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import money
from tidemill.functions.temporal import day_start, month_tag, whole_minutes

# Fixed value: the referrer of a session's first page.
SITE_ROOT = "https://example.com"


def with_line_total(items: DataFrame) -> DataFrame:
    """Add ``line_total``, quantity times unit price in whole cents."""
    return items.withColumn(
        "line_total", money.line_total(F.col("quantity"), F.col("unit_price"))
    )


def order_rollup(items: DataFrame) -> DataFrame:
    """Lines and sum of line totals per order."""
    totals = with_line_total(items).groupBy("order_id")
    return totals.agg(
        F.count("*").alias("lines"), money.total(F.col("line_total")).alias("items_total")
    )


def order_total_mismatches(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose total differs from the sum of their lines, or that have none.

    Both sides hold one row per order when they meet, whatever order the lines
    crowd in.
    """
    joined = orders.select("order_id", "total_amount").join(
        order_rollup(items), "order_id", "left"
    )
    same = money.same(F.col("total_amount"), F.col("items_total"))
    return joined.where(~same).select("order_id", "total_amount", "items_total")


def payment_amount_mismatches(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments whose amount differs from the total of their order, or that have none."""
    joined = payments.select("payment_id", "order_id", "amount").join(
        orders.select("order_id", "total_amount"), "order_id", "left"
    )
    same = money.same(F.col("amount"), F.col("total_amount"))
    return joined.where(~same).select("payment_id", "order_id", "amount", "total_amount")


def orders_with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders shipped to the address of their customer.

    No broadcast hint: customers grow with the data. Spark broadcasts them
    while they are below its size limit, and splits the partition of a hot
    customer beyond it.
    """
    address = customers.select("customer_id", F.col("address").alias("shipping_address"))
    kept = [c for c in orders.columns if c != "shipping_address"]
    return orders.select(*kept).join(address, "customer_id").select(*kept, "shipping_address")


def payment_lag(payments: DataFrame, orders: DataFrame, within_minutes: int = 60) -> DataFrame:
    """Payments made up to ``within_minutes`` after their order, with the lag."""
    paid = payments.select("payment_id", "order_id", "created_at")
    placed = orders.select("order_id", "order_date")
    latest = F.col("order_date") + F.expr(f"INTERVAL {int(within_minutes)} MINUTES")
    joined = paid.join(placed, "order_id").where(
        F.col("created_at").between(F.col("order_date"), latest)
    )
    lag = whole_minutes(F.col("order_date"), F.col("created_at"))
    return joined.select("payment_id", "order_id", lag.alias("lag_minutes"))


def with_resolution_minutes(
    cases: DataFrame, start: str, end: str, name: str = "resolution_time_minutes"
) -> DataFrame:
    """Whole minutes from start to end, NULL while the case is open."""
    return cases.withColumn(name, whole_minutes(F.col(start), F.col(end)))


def with_month_tag(rows: DataFrame, date: str) -> DataFrame:
    """Add ``month_tag`` (``_YYYYMM``) and ``day_start`` of a date column."""
    return rows.withColumns(
        {"month_tag": month_tag(F.col(date)), "day_start": day_start(F.col(date))}
    )


def with_previous(
    events: DataFrame,
    session: str,
    time: str,
    tie: str,
    value: str,
    name: str = "previous",
    first: str | None = SITE_ROOT,
    cells: tuple[str, ...] = ("day", "minute"),
) -> DataFrame:
    """Add the value of the session's event before this one, or ``first``.

    Equal to ``lag(value) OVER (PARTITION BY session ORDER BY time, tie)``, but
    a session that holds a large part of all events is cut into pieces as long
    as the last of the ``cells``, each a task's work of its own. The last value
    of a piece is carried into the session's next piece, where it sorts before
    the events. Events without a time have no place in the order: they get
    ``first`` and precede nothing.
    """
    kind = dict(events.dtypes)[time]
    marks = [f"__{cell}" for cell in cells]
    dated = events.withColumns(
        {m: F.date_trunc(c, F.col(time)).cast(kind) for m, c in zip(marks, cells)}
    )
    tails = (
        dated.where(F.col(time).isNotNull())
        .groupBy(session, *marks)
        .agg(F.max_by(F.struct(value), F.struct(time, tie)).alias("__last"))
    )
    rows = dated.withColumn("__rank", F.lit(1))
    for carried in _carried(tails, session, marks):
        brought = carried.select(session, *marks, "__last.*", F.lit(0).alias("__rank"))
        rows = rows.unionByName(brought, allowMissingColumns=True)
    # Undated events would share one piece; the tie column sets them apart.
    undated = F.when(F.col(marks[-1]).isNull(), F.col(tie))
    order = Window.partitionBy(session, *marks, undated).orderBy("__rank", time, tie)
    before = F.lag(F.struct(value)).over(order)
    previous = F.when(before.isNull(), F.lit(first)).otherwise(before.getField(value))
    return rows.withColumn(name, previous).where(F.col("__rank") == 1).drop(*marks, "__rank")


def _carried(tails: DataFrame, session: str, marks: list[str]) -> list[DataFrame]:
    """Each piece's last value, moved to the next piece of the session.

    From the shortest cells up: a piece hands its value to the next one within
    the longer cell, and the last of them to the first piece of the next longer
    cell. A window thus holds at most the pieces of one cell, and at the top
    the cells of the session's time span.
    """
    pieces = tails.withColumn("__start", F.struct(*marks))
    moves = []
    for depth in reversed(range(len(marks))):
        longer = [session, *marks[:depth]]
        following = F.lead("__start").over(Window.partitionBy(*longer).orderBy(marks[depth]))
        linked = pieces.withColumn("__next", following)
        moves.append(
            linked.where(F.col("__next").isNotNull()).select(session, "__next.*", "__last")
        )
        pieces = linked.groupBy(*longer).agg(
            F.min_by("__start", marks[depth]).alias("__start"),
            F.max_by("__last", marks[depth]).alias("__last"),
        )
    return moves
