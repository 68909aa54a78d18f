"""The whole report: reader's choices first, then every figure of every section."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog import DATASETS
from tidemill.functions import money
from tidemill.functions.temporal import minute_label
from tidemill.operators import kpi
from tidemill.operators.filters import (
    DEFAULT_WINDOW,
    WINDOW_CHOICES,
    in_list,
    in_options,
    options,
    recent_days,
)
from tidemill.sources.lake import (
    NEWEST_FILES,
    NEWEST_FILES_DEFAULT,
    load_dataset,
    preview,
)

# The time column the window applies to; other datasets are shown whole.
WINDOW_COLUMNS = {
    "orders": "order_date",
    "payments": "created_at",
    "web_events": "event_timestamp",
    "support_tickets": "created_at",
    "incidents": "created_at",
    "marketing_spend": "spend_date",
}
# The column with a value list, where a dataset has one.
OPTION_COLUMNS = {
    "orders": "status",
    "web_events": "event_type",
    "support_tickets": "priority",
}
PREVIEWED = ("orders", "payments", "web_events", "support_tickets")


@dataclass(frozen=True)
class Choices:
    """What the reader selected. ``selected`` maps a dataset to values; absent means all of them."""

    window: str = DEFAULT_WINDOW
    selected: dict[str, list[str]] | None = None


def load_lake(
    spark: SparkSession, lake: str, newest_only: bool = False, located: bool = False
) -> dict[str, DataFrame]:
    """Every dataset of a lake, whole or cut to its newest files; ``located`` for previews."""
    frames = {}
    for spec in DATASETS:
        newest = NEWEST_FILES.get(spec.name, NEWEST_FILES_DEFAULT) if newest_only else None
        path = spec.lake_path(lake)
        frames[spec.name] = load_dataset(spark, path, spec, newest=newest, located=located)
    return frames


def choose(name: str, frame: DataFrame, choices: Choices) -> DataFrame:
    """One dataset as the reader sees it: the window first, then the value list.

    With nothing deselected the list holds every value, so rows without one are
    left out; an empty selection filters nothing.
    """
    whole = frame
    if name in WINDOW_COLUMNS:
        frame = recent_days(frame, WINDOW_COLUMNS[name], WINDOW_CHOICES[choices.window])
    if name in OPTION_COLUMNS:
        selected = (choices.selected or {}).get(name)
        column = OPTION_COLUMNS[name]
        if selected is None:
            return in_options(frame, column, offered_by=whole)
        return in_list(frame, column, selected)
    return frame


def option_lists(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The values on offer, from the data before any filter."""
    return {name: options(frames[name], column) for name, column in OPTION_COLUMNS.items()}


def _health(*frames: DataFrame) -> DataFrame:
    return kpi.dataset_health(dict(zip(kpi.FRESHNESS_COLUMNS, frames)))


def _overview_labels(*frames: DataFrame) -> DataFrame:
    return kpi.overview_labels(kpi.overview(*frames))


# Every figure of the report: the datasets it is made of, and how.
FIGURES: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "overview": (("orders", "payments", "customers", "products"), kpi.overview),
    "overview_labels": (("orders", "payments", "customers", "products"), _overview_labels),
    "web_event_rows": (("web_events",), partial(kpi.row_count, name="web_events")),
    "dataset_health": (tuple(kpi.FRESHNESS_COLUMNS), _health),
    "orders_by_status": (("orders",), partial(kpi.count_by, key="status", name="orders")),
    "revenue_by_day": (("orders",), kpi.revenue_by_day),
    "order_value_bands": (("orders",), kpi.value_bands),
    "payment_success_rate": (("payments",), kpi.payment_success_rate),
    "payments_by_status": (("payments",), partial(kpi.count_by, key="status", name="payments")),
    "payments_by_method": (
        ("payments",),
        partial(kpi.count_by, key="payment_method", name="payments"),
    ),
    "events_by_type": (("web_events",), partial(kpi.count_by, key="event_type", name="events")),
    "hourly_events": (("web_events",), kpi.hourly_events),
    "sessions_and_purchases": (("web_events",), kpi.sessions_and_purchases),
    "tickets_by_priority": (
        ("support_tickets",),
        partial(kpi.count_by, key="priority", name="tickets"),
    ),
    "incidents_by_severity": (
        ("incidents",),
        partial(kpi.count_by, key="severity", name="incidents"),
    ),
    "spend_by_channel": (
        ("marketing_spend",),
        partial(kpi.sum_by, key="channel", amount="amount", name="spend"),
    ),
}


def figure(name: str, frames: Mapping[str, DataFrame], choices: Choices = Choices()) -> DataFrame:
    """One figure of the report after the reader's choices."""
    datasets, make = FIGURES[name]
    return make(*[choose(dataset, frames[dataset], choices) for dataset in datasets])


def sections(
    frames: Mapping[str, DataFrame], choices: Choices = Choices()
) -> dict[str, DataFrame]:
    """Every figure of the report, each a DataFrame of its own, by name.

    Each reads the few columns it needs. ``single_pass`` reads a dataset once
    for all its charts.
    """
    return {name: figure(name, frames, choices) for name in FIGURES}


def single_pass(
    frames: Mapping[str, DataFrame], choices: Choices = Choices()
) -> dict[str, DataFrame]:
    """The charts of the large datasets, one scan each: rows of (chart, value, measures)."""
    seen = {
        name: choose(name, frames[name], choices) for name in ("orders", "payments", "web_events")
    }
    amount = F.col("total_amount")
    return {
        "orders": kpi.in_one_pass(
            seen["orders"],
            {
                "status": F.col("status"),
                "order_day": F.col("order_date").cast("date"),
                "band": kpi.value_band(amount),
            },
            {
                "orders": F.count("*"),
                "revenue": money.total(amount),
                "average_order_value": money.mean(amount),
            },
        ),
        "payments": kpi.in_one_pass(
            seen["payments"],
            {"status": F.col("status"), "payment_method": F.col("payment_method")},
            {"payments": F.count("*"), "completed": F.count_if(F.col("status") == "completed")},
        ),
        "web_events": kpi.in_one_pass(
            seen["web_events"],
            {
                "event_type": F.col("event_type"),
                "event_hour": minute_label(F.date_trunc("hour", F.col("event_timestamp"))),
            },
            {"events": F.count("*")},
        ),
    }


def previews(
    frames: Mapping[str, DataFrame], choices: Choices = Choices(), rows: int = 20
) -> dict[str, DataFrame]:
    """First rows of the inspected datasets, filtered, newest file first.

    The frames must be located, and are best those of the newest files only.
    """
    return {
        name: preview(choose(name, frames[name], choices), rows)
        for name in PREVIEWED
    }
