"""Commerce, traffic and operations figures.

All aggregates combine on the map side first, so one hot key costs one row per
task. Figures that make up one report row are computed in one pass and turned
into rows with ``stack``, which needs neither a join nor a shuffle by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import money
from tidemill.functions.temporal import lenient_timestamp, minute_label
from tidemill.operators.filters import window_conditions

# Upper edges and labels of the order-value bands.
VALUE_BANDS = ((100.0, "0-100"), (500.0, "100-500"), (float("inf"), ">500"))


def _stack(one_row: DataFrame, names: tuple[str, ...], rows: list[tuple]) -> DataFrame:
    """One row of figures as several: each tuple holds the output columns of one row."""
    cells = [cell if isinstance(cell, Column) else F.lit(cell) for row in rows for cell in row]
    return one_row.select(F.stack(F.lit(len(rows)), *cells).alias(*names))


def row_count(frame: DataFrame, name: str = "rows") -> DataFrame:
    return frame.agg(F.count("*").alias(name))


def count_by(frame: DataFrame, key: str, name: str = "rows") -> DataFrame:
    """Rows per value, most frequent first; rows without a value are not counted."""
    counts = frame.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(name))
    return counts.orderBy(F.desc(name), key)


def sum_by(frame: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Amount per value, largest first; a value with only NULL amounts has 0.0."""
    sums = frame.where(F.col(key).isNotNull()).groupBy(key)
    return sums.agg(money.total(F.col(amount)).alias(name)).orderBy(F.desc(name), key)


def count_where(frame: DataFrame, condition: Column, name: str) -> DataFrame:
    return frame.agg(F.count_if(condition).alias(name))


def revenue(orders: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Sum over orders of every status; 0.0 when there are none."""
    return orders.agg(money.total(F.col(amount)).alias("revenue"))


def average_order_value(orders: DataFrame, amount: str = "total_amount") -> DataFrame:
    return orders.agg(money.mean(F.col(amount)).alias("average_order_value"))


def completed_payments(payments: DataFrame, status: str = "status") -> DataFrame:
    return count_where(payments, F.col(status) == "completed", "completed_payments")


def overview(
    orders: DataFrame, payments: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """The overview figures in one row.

    The orders aggregate is the row; the other tables add scalar subqueries,
    which run side by side.
    """
    amount = F.col("total_amount")
    card = orders.agg(
        F.count("*").alias("orders"),
        money.total(amount).alias("revenue"),
        money.mean(amount).alias("average_order_value"),
    )
    return card.select(
        "*",
        completed_payments(payments).scalar().alias("completed_payments"),
        row_count(customers).scalar().alias("customers"),
        row_count(products).scalar().alias("products"),
    )


def overview_labels(card: DataFrame) -> DataFrame:
    """The overview row as the text shown on its cards."""
    both = F.concat(
        money.format_count(F.col("customers")), F.lit(" / "), money.format_count(F.col("products"))
    )
    average = money.format_currency(F.col("average_order_value"))
    return card.select(
        money.format_count(F.col("orders")).alias("orders"),
        money.format_currency(F.col("revenue")).alias("revenue"),
        F.concat(F.lit("Average order value: "), average).alias("revenue_note"),
        money.format_count(F.col("completed_payments")).alias("completed_payments"),
        both.alias("customers_products"),
    )


def latest(frame: DataFrame, candidates: list[str]) -> Column:
    """Aggregate: newest time of the first candidate column that has any, else ``n/a``."""
    types = dict(frame.dtypes)
    newest = [
        F.max(lenient_timestamp(F.col(c), types[c])).cast("timestamp")
        for c in candidates
        if c in types
    ]
    if not newest:
        return F.lit("n/a")
    return F.coalesce(minute_label(F.coalesce(*newest)), F.lit("n/a"))


def latest_timestamp(frame: DataFrame, candidates: list[str]) -> DataFrame:
    return frame.agg(latest(frame, candidates).alias("latest"))


# Which time columns tell how fresh a dataset is, in order of preference.
FRESHNESS_COLUMNS = {
    "orders": ["order_date", "_ingested_at", "kafka_timestamp"],
    "payments": ["created_at", "updated_at", "_ingested_at"],
    "web_events": ["event_timestamp", "_ingested_at"],
    "support_tickets": ["created_at", "resolved_at", "_ingested_at"],
    "incidents": ["updated_at", "created_at", "_ingested_at"],
}


def dataset_health(
    frames: dict[str, DataFrame], candidates: dict[str, list[str]] = FRESHNESS_COLUMNS
) -> DataFrame:
    """Per dataset: rows and newest time, an empty dataset with 0 and ``n/a``."""
    rows = [
        frames[name].agg(
            F.lit(name).alias("dataset"),
            F.count("*").alias("rows"),
            latest(frames[name], columns).alias("latest"),
        )
        for name, columns in candidates.items()
    ]
    return reduce(DataFrame.unionAll, rows)


def revenue_by_day(
    orders: DataFrame, time: str = "order_date", amount: str = "total_amount"
) -> DataFrame:
    """Revenue per calendar day, oldest first; undated orders are left out."""
    moment = lenient_timestamp(F.col(time), dict(orders.dtypes)[time])
    daily = orders.where(moment.isNotNull()).groupBy(moment.cast("date").alias("order_day"))
    return daily.agg(money.total(F.col(amount)).alias("revenue")).orderBy("order_day")


def by_window(orders: DataFrame, time: str, amount: str) -> DataFrame:
    """Orders and revenue inside each window choice, from one scan and one for the newest time."""
    inside = window_conditions(orders, time)
    cells, rows = [], []
    for i, (label, condition) in enumerate(inside.items()):
        cells.append(F.count_if(condition).alias(f"orders_{i}"))
        cells.append(money.total(F.when(condition, F.col(amount))).alias(f"revenue_{i}"))
        rows.append((label, F.col(f"orders_{i}"), F.col(f"revenue_{i}")))
    return _stack(orders.agg(*cells), ("window", "orders", "revenue"), rows)


def _in_band(value: Column, lower: float | None, upper: float) -> Column:
    above = value >= 0 if lower is None else value > lower
    # NaN sorts above every number in Spark, but is a missing amount here.
    return above & (value <= upper) & ~F.isnan(value)


def _band_conditions(
    value: Column, bands: tuple[tuple[float, str], ...]
) -> list[tuple[str, Column]]:
    lowers = [None, *[upper for upper, _ in bands]]
    return [(label, _in_band(value, low, up)) for low, (up, label) in zip(lowers, bands)]


def value_band(
    amount: Column, bands: tuple[tuple[float, str], ...] = VALUE_BANDS
) -> Column:
    """The label of an amount's band, NULL in none."""
    labels = [F.when(inside, label) for label, inside in _band_conditions(amount, bands)]
    return F.coalesce(*labels)


def value_bands(
    orders: DataFrame,
    amount: str = "total_amount",
    bands: tuple[tuple[float, str], ...] = VALUE_BANDS,
) -> DataFrame:
    """Orders per value band, lowest band first, empty bands with 0.

    A band includes its upper edge, the first also 0; negative and missing
    amounts are in none.
    """
    conditions = _band_conditions(F.col(amount), bands)
    counts = [F.count_if(inside).alias(f"band_{i}") for i, (_, inside) in enumerate(conditions)]
    rows = [(label, F.col(f"band_{i}")) for i, (label, _) in enumerate(conditions)]
    return _stack(orders.agg(*counts), ("band", "orders"), rows)


def payment_success_rate(payments: DataFrame, status: str = "status") -> DataFrame:
    """Completed payments in percent of all, a missing status counting as not completed."""
    share = F.try_divide(
        F.lit(100.0) * F.count_if(F.col(status) == "completed"), F.count("*")
    )
    return payments.agg(F.coalesce(share, F.lit(0.0)).alias("success_rate"))


def success_caption(rate: DataFrame) -> DataFrame:
    """The success rate as the text below its chart."""
    shown = money.format_percent(F.col("success_rate"))
    return rate.select(F.concat(F.lit("Success rate: "), shown).alias("caption"))


def traffic_caption(counts: DataFrame) -> DataFrame:
    """Sessions and purchases as the text above their charts."""
    parts = [
        F.lit("Sessions: "), money.format_count(F.col("sessions")),
        F.lit(" | Purchase events: "), money.format_count(F.col("purchases")),
    ]
    return counts.select(F.concat(*parts).alias("caption"))


def hourly_events(events: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """Events per hour, oldest first; undated events are left out."""
    kind = dict(events.dtypes)[time]
    moment = lenient_timestamp(F.col(time), kind)
    hour = F.date_trunc("hour", moment)
    if kind == "timestamp_ntz":
        hour = hour.cast("timestamp_ntz")
    series = events.where(moment.isNotNull()).groupBy(hour.alias("event_hour"))
    return series.agg(F.count("*").alias("events")).orderBy("event_hour")


def sessions_and_purchases(
    events: DataFrame,
    session: str = "session_id",
    event_type: str = "event_type",
    approximate: bool = False,
) -> DataFrame:
    """Distinct sessions and purchase events.

    The exact count shuffles one row per task and session. ``approximate``
    sends one sketch per task instead, with a standard error of 5 %.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return events.agg(
        distinct(F.col(session)).alias("sessions"),
        F.count_if(F.col(event_type) == "purchase").alias("purchases"),
    )


# The steps of a purchase, in order.
FUNNEL_STEPS = ("page_view", "add_to_cart", "checkout_start", "payment_info", "purchase")


def funnel_reach(
    events: DataFrame,
    steps: tuple[str, ...] = FUNNEL_STEPS,
    session: str = "session_id",
    event_type: str = "event_type",
) -> DataFrame:
    """How many sessions got as far as each step, or further, and the share that did.

    A session's depth is its deepest step; reaching a step implies the earlier
    ones. Events without a session are left out.
    """
    depth = F.coalesce(
        *[F.when(F.col(event_type) == step, n) for n, step in enumerate(steps, 1)]
    )
    known = events.where(F.col(session).isNotNull())
    depths = known.groupBy(session).agg(F.max(depth).alias("depth"))
    reached = depths.agg(
        *[F.count_if(F.col("depth") >= n).alias(f"reach_{n}") for n in range(1, len(steps) + 1)]
    )
    rows = []
    for n, step in enumerate(steps, 1):
        reach, before = F.col(f"reach_{n}"), F.col(f"reach_{max(n - 1, 1)}")
        share = F.try_divide(reach, F.col("reach_1"))
        rows.append((n, step, reach, share, F.try_divide(reach, before)))
    names = ("step", "event_type", "sessions", "share_of_first", "share_of_previous")
    return _stack(reached, names, rows)


def in_one_pass(
    frame: DataFrame, keys: dict[str, Column], measures: dict[str, Column]
) -> DataFrame:
    """Several charts and the total from one scan, by grouping sets.

    A row per chart and value (as text), the total under ``all``; rows without
    a value are in the total only, and an empty frame has a total of its own, as
    the single figures have. Partial aggregation cuts each task's rows to the
    values it saw.
    """
    names = list(keys)
    keyed = frame.withColumns({f"__{n}": key for n, key in keys.items()})
    marked = [f"__{n}" for n in names]
    sets = keyed.groupingSets([[m] for m in marked] + [[]], *marked).agg(
        *[measure.alias(n) for n, measure in measures.items()],
        *[F.grouping(m).alias(f"{m}_absent") for m in marked],
    )
    grouped = [(n, F.col(f"__{n}_absent") == 0) for n in names]
    chart = F.coalesce(*[F.when(present, n) for n, present in grouped], F.lit("all"))
    value = F.coalesce(
        *[F.when(present, F.col(f"__{n}").cast("string")) for n, present in grouped]
    )
    rows = sets.select(chart.alias("chart"), value.alias("value"), *measures)
    found = rows.where(F.col("value").isNotNull() | (F.col("chart") == "all"))
    # An empty grouping set of no rows gives no row: a global aggregate of none gives it.
    nothing = keyed.limit(1).agg(
        F.count("*").alias("__n"), *[measure.alias(n) for n, measure in measures.items()]
    ).where("__n = 0")
    return found.unionByName(
        nothing.select(F.lit("all").alias("chart"), F.lit(None).cast("string").alias("value"), *measures)
    )
