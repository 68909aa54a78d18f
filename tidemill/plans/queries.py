"""Every operator as a query over the benchmark tables: (session, folder) -> DataFrame.

Times leave as ``timestamp_ntz``, so that values do not depend on a session zone.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill import catalog
from tidemill.catalog import CHANGE_DATASETS, DATASETS, PARTITION_COLUMNS, DatasetSpec
from tidemill.functions import money, temporal
from tidemill.operators import envelope, filters, insert, kpi, quality, rules
from tidemill.operators.enrich import add_ingestion_metadata, convert_times, enrich
from tidemill.operators.rollups import RollupSpec, merged, partials
from tidemill.plans import dashboard
from tidemill.plans.shop import SHOP, VISIT_STEPS, table
from tidemill.session import configure, scratch_path, stage
from tidemill.sources import buckets, footers, lake, offsets, tables
from tidemill.sources.logs import (
    BACKFILL_OFFSETS, FOLLOW_OFFSETS, LOG_SCHEMA, FileLog, table_topics,
)
from tidemill.streaming import inserts, landing, sinks
from tidemill.streaming.compaction import CompactedLake
from tidemill.streaming.lags import payment_lag_stream
from tidemill.streaming.rollups import RollupTable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

PREFIX = "shop"
BUCKETS = 8


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def comparable(frame: DataFrame) -> DataFrame:
    """Timestamps without a zone."""
    return frame.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in frame.dtypes
        ]
    )


def shop(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named datasets, or all of them."""
    return {name: SHOP[name](spark, sf_dir) for name in names or SHOP}


def row_columns(spec: DatasetSpec) -> list[str]:
    return [f.name for f in spec.fields]


# ---------------------------------------------------------------- overview and orders


@query
def overview_card(spark, sf_dir):
    return kpi.overview(
        *shop(spark, sf_dir, "orders", "payments", "customers", "products").values()
    )


@query
def overview_labels(spark, sf_dir):
    return kpi.overview_labels(overview_card(spark, sf_dir))


@query
def orders_count(spark, sf_dir):
    return kpi.row_count(SHOP["orders"](spark, sf_dir), "orders")


@query
def web_events_count(spark, sf_dir):
    return kpi.row_count(SHOP["web_events"](spark, sf_dir), "web_events")


@query
def revenue_total(spark, sf_dir):
    return kpi.revenue(SHOP["orders"](spark, sf_dir))


@query
def average_order_value(spark, sf_dir):
    return kpi.average_order_value(SHOP["orders"](spark, sf_dir))


@query
def completed_payments(spark, sf_dir):
    return kpi.completed_payments(SHOP["payments"](spark, sf_dir))


@query
def customer_and_product_counts(spark, sf_dir):
    customers = kpi.row_count(SHOP["customers"](spark, sf_dir), "customers")
    products = kpi.row_count(SHOP["products"](spark, sf_dir), "products")
    return customers.select("*", products.scalar().alias("products"))


@query
def orders_by_status(spark, sf_dir):
    return kpi.count_by(SHOP["orders"](spark, sf_dir), "status", "orders")


@query
def revenue_by_day(spark, sf_dir):
    return kpi.revenue_by_day(SHOP["orders"](spark, sf_dir))


@query
def revenue_by_day_rolled_up(spark, sf_dir):
    """Revenue by day from partial aggregates, refreshed after each of three landings."""
    orders, root = SHOP["orders"](spark, sf_dir), scratch_path(spark, "lake")
    spec = RollupSpec({"order_day": "to_date(order_date)", "status": "status"}, {"revenue": "total_amount"})
    kept = RollupTable(scratch_path(spark, "rollup"), root, orders.schema, spec)
    for status in ("F", "O", "P"):
        orders.where(F.col("status") == status).write.mode("append").parquet(root)
        kept.refresh(spark)
    return kept.figures(spark, "order_day").where("order_day is not null").select("order_day", "revenue")


@query
def visitors_estimated(spark, sf_dir):
    """Whether distinct sessions and customers from merged sketches come within 5 percent, for every window choice."""
    events = SHOP["web_events"](spark, sf_dir)
    spec = RollupSpec(
        {"hour": "date_trunc('hour', event_timestamp)"},
        distinct={"sessions": "session_id", "customers": "customer_id"},
    )
    kept = stage(partials(events, spec), "partials")
    newest = events.agg(F.max("event_timestamp"))
    results = []
    for choice, days in filters.WINDOW_CHOICES.items():
        # A window of whole hours, for sketches and rows alike.
        since = F.date_trunc("hour", newest.scalar() - F.expr(f"INTERVAL {days or 100_000} DAYS"))
        guess = merged(kept.where(F.col("hour") >= since), spec)
        exact = events.where(F.date_trunc("hour", "event_timestamp") >= since).agg(
            F.count("*").alias("events"), F.count_distinct("session_id").alias("s"), F.count_distinct("customer_id").alias("c")
        )
        near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.05 * F.col(b)
        both = exact.select("*", guess.select(F.struct("rows", "sessions", "customers")).scalar().alias("guess")).select("events", "s", "c", "guess.*")
        results.append(both.select(
            F.lit(choice).alias("window"), (F.col("rows") == F.col("events")).alias("same_rows"), "events",
            near("sessions", "s").alias("sessions_near"), near("customers", "c").alias("customers_near"),
        ))
    return reduce(DataFrame.unionAll, results)


@query
def order_value_bands(spark, sf_dir):
    return kpi.value_bands(SHOP["orders"](spark, sf_dir))


@query
def order_value_bands_wide(spark, sf_dir):
    edges = ((100000.0, "0-100k"), (250000.0, "100k-250k"), (float("inf"), ">250k"))
    return kpi.value_bands(SHOP["orders"](spark, sf_dir), bands=edges)


@query
def balance_bands(spark, sf_dir):
    """Balances go below zero: those are in no band."""
    edges = ((2500.0, "0-2500"), (5000.0, "2500-5000"), (float("inf"), ">5000"))
    return kpi.value_bands(table(spark, sf_dir, "customer"), "c_acctbal", edges)


# ---------------------------------------------------------------- payments, traffic, operations


@query
def payment_success_rate(spark, sf_dir):
    return kpi.payment_success_rate(SHOP["payments"](spark, sf_dir))


@query
def success_caption(spark, sf_dir):
    return kpi.success_caption(payment_success_rate(spark, sf_dir))


@query
def payments_by_status(spark, sf_dir):
    return kpi.count_by(SHOP["payments"](spark, sf_dir), "status", "payments")


@query
def payments_by_method(spark, sf_dir):
    return kpi.count_by(SHOP["payments"](spark, sf_dir), "payment_method", "payments")


@query
def events_by_type(spark, sf_dir):
    return kpi.count_by(SHOP["web_events"](spark, sf_dir), "event_type", "events")


@query
def hourly_events(spark, sf_dir):
    return kpi.hourly_events(SHOP["web_events"](spark, sf_dir))


@query
def sessions_and_purchases(spark, sf_dir):
    return kpi.sessions_and_purchases(SHOP["web_events"](spark, sf_dir))


@query
def traffic_caption(spark, sf_dir):
    return kpi.traffic_caption(sessions_and_purchases(spark, sf_dir))


@query
def tickets_by_priority(spark, sf_dir):
    return kpi.count_by(SHOP["support_tickets"](spark, sf_dir), "priority", "tickets")


@query
def incidents_by_severity(spark, sf_dir):
    return kpi.count_by(SHOP["incidents"](spark, sf_dir), "severity", "incidents")


@query
def spend_by_channel(spark, sf_dir):
    return kpi.sum_by(SHOP["marketing_spend"](spark, sf_dir), "channel", "amount", "spend")


@query
def balance_by_segment(spark, sf_dir):
    return kpi.sum_by(table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal", "balance")


@query
def funnel_reach(spark, sf_dir):
    return kpi.funnel_reach(SHOP["web_events"](spark, sf_dir), VISIT_STEPS)


@query
def latest_timestamps(spark, sf_dir):
    """The newest resolution; a column without values falls back to the next; neither gives n/a."""
    tickets = SHOP["support_tickets"](spark, sf_dir).withColumn(
        "never", F.lit(None).cast("timestamp_ntz")
    )
    return tickets.agg(
        kpi.latest(tickets, ["resolved_at", "created_at"]).alias("resolved"),
        kpi.latest(tickets, ["never", "created_at"]).alias("fallback"),
        kpi.latest(tickets, ["never", "absent"]).alias("nothing"),
    )


@query
def dataset_health(spark, sf_dir):
    return kpi.dataset_health(shop(spark, sf_dir, *kpi.FRESHNESS_COLUMNS))


@query
def preview_orders(spark, sf_dir):
    """The first 20 rows of a dataset, newest file first."""
    path = f"{sf_dir}/orders.parquet"
    return lake.first_rows(spark, path, table(spark, sf_dir, "orders").schema)


def _orders_by_hour(spark, sf_dir):
    """Orders landed in batches, one folder and file for each hour of a day."""
    root = scratch_path(spark, "lake")
    hours = table(spark, sf_dir, "orders").withColumns(
        {
            "year": F.lit("2024"), "month": F.lit("01"), "day": F.lit("02"),
            "hour": F.lpad(F.pmod("o_orderkey", F.lit(24)).cast("string"), 2, "0"),
        }
    )
    sinks.land_batch(hours.repartition("hour").sortWithinPartitions("hour", "o_orderkey"), root)
    return root, hours.schema


@query
def newest_files_rows(spark, sf_dir):
    """The rows of the newest five files of a lake that has more."""
    root, schema = _orders_by_hour(spark, sf_dir)
    return lake.load_dataset(spark, root, schema, newest=5).select("o_orderkey", "hour")


@query
def rows_by_hour(spark, sf_dir):
    """Rows of each landed hour, from the files' footers alone."""
    root, _ = _orders_by_hour(spark, sf_dir)
    return footers.rows_by_hour(spark, root)


@query
def compacted_orders(spark, sf_dir):
    """A lake of many small files, rewritten as few sorted ones: the same rows, and new ones beside them."""
    root, schema = _orders_by_hour(spark, sf_dir)
    kept = CompactedLake(root, scratch_path(spark, "compact"), schema, crowded=1)
    kept.compact(spark, "o_orderkey")
    late = spark.read.schema(schema).parquet(root).where("o_orderstatus = 'P'").withColumn("day", F.lit("03"))
    sinks.land_batch(late, root)
    return kept.rows(spark).select("o_orderkey", "o_orderstatus", "day", "hour")


@query
def preview_filtered(spark, sf_dir):
    """The first rows that pass a filter, where the newest files hold fewer than asked for."""
    root, schema = _orders_by_hour(spark, sf_dir)
    rare = "o_orderpriority = '1-URGENT' AND o_totalprice > 300000"
    return lake.first_rows(spark, root, schema, lambda rows: rows.where(rare), 30).select("hour", "o_orderkey")


# ---------------------------------------------------------------- filters and formats


@query
def recent_events_7d(spark, sf_dir):
    return filters.recent_days(SHOP["web_events"](spark, sf_dir), "event_timestamp", 7)


@query
def recent_orders_by_window(spark, sf_dir):
    """Every window choice: orders and revenue inside it."""
    return kpi.by_window(SHOP["orders"](spark, sf_dir), "order_date", "total_amount")


@query
def recent_spend_30d(spark, sf_dir):
    """A window over a date column."""
    recent = filters.recent_days(SHOP["marketing_spend"](spark, sf_dir), "spend_date", 30)
    return kpi.sum_by(recent, "channel", "amount", "spend")


@query
def status_filtered(spark, sf_dir):
    return filters.in_list(SHOP["orders"](spark, sf_dir), "status", ["F", "P"])


@query
def event_type_filtered(spark, sf_dir):
    return filters.in_list(SHOP["web_events"](spark, sf_dir), "event_type", ["purchase", "signup"])


@query
def priority_filtered(spark, sf_dir):
    kept = filters.in_list(SHOP["support_tickets"](spark, sf_dir), "priority", ["urgent", "high"])
    return kept.select("ticket_id", "priority", "created_at", "resolved_at")


@query
def status_options(spark, sf_dir):
    return filters.options(SHOP["orders"](spark, sf_dir), "status")


@query
def event_type_options(spark, sf_dir):
    return filters.options(SHOP["web_events"](spark, sf_dir), "event_type")


@query
def priority_options(spark, sf_dir):
    return filters.options(SHOP["support_tickets"](spark, sf_dir), "priority")


@query
def lenient_datetimes(spark, sf_dir):
    """Text that is a time is read, other text is NULL, an absent column is all NULL."""
    events = table(spark, sf_dir, "events").withColumn(
        "text", F.when(F.col("event_type") == "error", F.col("props")).otherwise(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        )
    )
    timed = filters.with_lenient_time(events, "text", "read_time")
    timed = filters.with_lenient_time(timed, "absent", "absent_time")
    return comparable(timed.select("event_id", "read_time", "absent_time"))


@query
def formatted_customers(spark, sf_dir):
    """Counts, currency and minute labels as text, per customer with orders."""
    per_customer = SHOP["orders"](spark, sf_dir).groupBy("customer_id").agg(
        F.count("*").alias("n"),
        money.total(F.col("total_amount")).alias("spent"),
        F.max("order_date").alias("last"),
    )
    return per_customer.select(
        "customer_id",
        money.format_count(F.col("n") * 1000).alias("orders"),
        money.format_currency(F.col("spent")).alias("spent"),
        temporal.minute_label(F.col("last")).alias("last_order"),
    )


@query
def report_over_90_days(spark, sf_dir):
    """The flagship: revenue by day as the report shows it with its default choices."""
    return dashboard.figure("revenue_by_day", shop(spark, sf_dir, "orders"))


@query
def report_rows(spark, sf_dir):
    """Every dataset after the reader's choices: 30 days, two statuses, one event type."""
    choices = dashboard.Choices(
        "30 days", {"orders": ["F", "O"], "web_events": ["purchase"], "support_tickets": []}
    )
    rows = [
        dashboard.choose(name, frame, choices).agg(
            F.lit(name).alias("dataset"), F.count("*").alias("rows")
        )
        for name, frame in shop(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionAll, rows)


def _single_pass(dataset: str) -> Query:
    def run(spark, sf_dir):
        frames = shop(spark, sf_dir, "orders", "payments", "web_events")
        return dashboard.single_pass(frames, dashboard.Choices("All"))[dataset]

    return run


for _name in ("orders", "payments", "web_events"):
    QUERIES[f"{_name}_in_one_pass"] = _single_pass(_name)


# ---------------------------------------------------------------- decoding and enrichment


def _round_trip(spec: DatasetSpec) -> Query:
    """Rows to change messages and back, through decoding and conversion."""

    def run(spark, sf_dir):
        messages = envelope.encode(SHOP[spec.name](spark, sf_dir), spec, PREFIX)
        landed = messages.transform(envelope.decode, spec).transform(convert_times, spec)
        return comparable(landed.select(*row_columns(spec)))

    return run


for _spec in CHANGE_DATASETS:
    QUERIES[f"cdc_roundtrip_{_spec.name}"] = _round_trip(_spec)


@query
def web_decode(spark, sf_dir):
    return _round_trip(catalog.WEB_EVENTS)(spark, sf_dir)


def _changes(spark, sf_dir):
    """Orders as changes: F was created, O updated, P deleted."""
    orders = SHOP["orders"](spark, sf_dir)
    status = F.col("status")
    op = F.when(status == "F", "c").when(status == "O", "u").otherwise("d")
    return envelope.encode(orders, catalog.ORDERS, PREFIX, op)


@query
def cdc_drops_deletes(spark, sf_dir):
    landed = _changes(spark, sf_dir).transform(envelope.decode, catalog.ORDERS)
    landed = landed.transform(convert_times, catalog.ORDERS)
    return comparable(landed.select("op", *row_columns(catalog.ORDERS)))


@query
def cdc_rejects(spark, sf_dir):
    dropped = envelope.rejected(_changes(spark, sf_dir), catalog.ORDERS)
    return dropped.groupBy("topic", "op", "message").agg(F.count("*").alias("rows"))


@query
def cdc_unreadable_messages(spark, sf_dir):
    """Event properties are JSON, but no change events: all are dropped, with clicks all are kept."""
    log = table(spark, sf_dir, "events").select(
        F.col("props").cast("binary").alias("value"),
        F.lit("x").alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    changes = envelope.decode(log, catalog.ORDERS).agg(F.count("*").alias("changes"))
    clicks = envelope.decode(log, catalog.WEB_EVENTS)
    return changes.select(
        "changes",
        clicks.agg(F.count("*")).scalar().alias("clicks"),
        clicks.agg(F.count("event_id")).scalar().alias("clicks_with_id"),
    )


@query
def cdc_encode_orders(spark, sf_dir):
    """The messages themselves, keys included."""
    return _changes(spark, sf_dir).select(
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("message"),
        "topic",
    )


@query
def event_messages(spark, sf_dir):
    """Clicks as the producer sends them."""
    sent = envelope.event_messages(SHOP["web_events"](spark, sf_dir))
    return sent.select(F.col("value").cast("string").alias("message"))


@query
def epoch_conversions(spark, sf_dir):
    """Millis to times, exact and cut to whole seconds, and days to dates."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        temporal.to_epoch_millis(F.col("ts")).alias("millis"),
        temporal.to_epoch_days(F.col("ts")).alias("days"),
    )
    converted = events.select(
        "event_id",
        "millis",
        "days",
        temporal.epoch_millis(F.col("millis")).alias("exact_time"),
        temporal.epoch_millis(F.col("millis"), whole_seconds=True).alias("second_time"),
        temporal.epoch_days(F.col("days")).alias("day"),
        # Millis are no day number a date can hold.
        temporal.epoch_days(F.col("millis")).alias("no_day"),
    )
    return comparable(converted)


@query
def iso_conversions(spark, sf_dir):
    """ISO text there and back, with and without a fraction, a zone offset, and text that is none."""
    events = table(spark, sf_dir, "events")
    text = temporal.to_iso(F.col("ts"))
    seconds = temporal.to_iso(F.date_trunc("second", F.col("ts")))
    read = events.select(
        "event_id",
        text.alias("text"),
        seconds.alias("text_seconds"),
        temporal.iso_timestamp(text).alias("read_time"),
        temporal.iso_timestamp(F.concat(seconds, F.lit("+02:00"))).alias("offset_time"),
        temporal.iso_timestamp(F.col("props")).alias("no_time"),
    )
    return comparable(read)


@query
def partition_columns(spark, sf_dir):
    """Partition values, taken here from the event time instead of the ingestion time."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    stamped = add_ingestion_metadata(events, now=F.col("ts").cast("timestamp"))
    return stamped.select("event_id", *PARTITION_COLUMNS)


@query
def enriched_payments(spark, sf_dir):
    """Decode, convert and stamp with a fixed ingestion time: the whole landed row."""
    paid_at = F.col("created_at").cast("timestamp")
    messages = envelope.encode(
        SHOP["payments"](spark, sf_dir), catalog.PAYMENTS, PREFIX, "c", paid_at
    )
    landed = messages.transform(envelope.decode, catalog.PAYMENTS).transform(
        enrich, catalog.PAYMENTS, F.to_timestamp(F.lit("2024-02-03 04:05:06"))
    )
    return comparable(landed)


# ---------------------------------------------------------------- logs, lake and streams


def _mixed_messages(spark, sf_dir):
    """Every dataset's messages, and one topic per event type that no dataset is registered for."""
    known = [envelope.encode(SHOP[s.name](spark, sf_dir), s, PREFIX) for s in DATASETS]
    events = table(spark, sf_dir, "events")
    stray = events.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(
            F.struct(F.lit("c").alias("op"), F.struct("event_id", "event_type").alias("after"))
        )
        .cast("binary")
        .alias("value"),
        F.concat(F.lit(f"{PREFIX}.public.returns_"), F.col("event_type")).alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    return reduce(DataFrame.unionByName, [*known, stray])


@query
def topic_routing(spark, sf_dir):
    """Messages per dataset, each reading its own topic of one log."""
    log = FileLog(scratch_path(spark, "log"))
    log.append(_mixed_messages(spark, sf_dir))
    routed = [
        log.read(spark, spec.topic(PREFIX)).agg(
            F.lit(spec.name).alias("dataset"), F.count("*").alias("messages")
        )
        for spec in DATASETS
    ]
    return reduce(DataFrame.unionAll, routed)


@query
def audit_unknown_topics(spark, sf_dir):
    """Changes to tables without a dataset, undecoded."""
    messages = _mixed_messages(spark, sf_dir)
    changes = messages.where(F.col("topic").rlike(f"^(?:{table_topics(PREFIX)})$"))
    known = [spec.topic(PREFIX) for spec in CHANGE_DATASETS]
    others = envelope.without_topics(envelope.peek(changes), known)
    return others.select("topic", "op", "after_json")


@query
def audit_stream(spark, sf_dir):
    """The same from a log of files, as a stream that lands what it finds."""
    log = FileLog(scratch_path(spark, "log"))
    log.append(_mixed_messages(spark, sf_dir))
    out, checkpoint = scratch_path(spark, "audit"), scratch_path(spark, "checkpoint")
    others = landing.unregistered_changes(spark, log, PREFIX, starting=BACKFILL_OFFSETS)
    writer = others.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(**sinks.ONCE).start(out).awaitTermination()
    return spark.read.schema(others.schema).parquet(out).select("topic", "op", "after_json")


@query
def lake_merged_columns(spark, sf_dir):
    """Frames with different columns as one: customers and suppliers as contacts."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("contact_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("contact_id"),
    )
    return filters.concat_frames(customers, suppliers)


@query
def lake_files_with_new_columns(spark, sf_dir):
    """A lake whose later files gained a column, read with their schemas merged."""
    root = scratch_path(spark, "lake")
    orders = SHOP["orders"](spark, sf_dir)
    finished, others = F.col("status") == "F", F.col("status") != "F"
    orders.where(finished).drop("shipping_address").write.parquet(f"{root}/a=1")
    orders.where(others).write.parquet(f"{root}/a=2")
    return lake.load_dataset(spark, root).drop("a")


@query
def landed_batch_orders(spark, sf_dir):
    """A batch appended to the partitioned lake, folders by order time, read back with its schema."""
    root = scratch_path(spark, "lake")
    messages = envelope.encode(SHOP["orders"](spark, sf_dir), catalog.ORDERS, PREFIX)
    rows = messages.transform(envelope.decode, catalog.ORDERS).transform(enrich, catalog.ORDERS)
    sinks.land_batch(rows, root)
    landed = lake.load_dataset(spark, root, catalog.ORDERS)
    return comparable(landed.select("op", *row_columns(catalog.ORDERS)))


@query
def fetched_customers(spark, sf_dir):
    return tables.fetch(SHOP["customers"](spark, sf_dir), catalog.CUSTOMERS)


@query
def tables_with_rows(spark, sf_dir):
    """Which datasets have rows; the last one is empty by construction."""
    frames = shop(spark, sf_dir)
    frames["no_orders"] = frames["orders"].where("total_amount < 0")
    return reduce(
        DataFrame.unionAll, [tables.presence(frame, name) for name, frame in frames.items()]
    )


def _stream_landed(spec: DatasetSpec) -> Query:
    """A dataset's messages from a log of files through the streaming sink, read back."""

    def run(spark, sf_dir):
        log = FileLog(scratch_path(spark, "log"))
        log.append(envelope.encode(SHOP[spec.name](spark, sf_dir), spec, PREFIX))
        root, checkpoints = scratch_path(spark, "lake"), scratch_path(spark, "checkpoint")
        landing.backfill(spark, spec, log, root, checkpoints, PREFIX)
        landed = lake.load_dataset(spark, spec.lake_path(root), spec)
        return comparable(landed.select(*row_columns(spec)))

    return run


for _spec in DATASETS:
    QUERIES[f"stream_{_spec.name}_landed"] = _stream_landed(_spec)


@query
def backfill_then_stream(spark, sf_dir):
    """History, a restart, then new messages, all through one checkpoint: nothing lost or doubled."""
    spec = catalog.ORDERS
    log = FileLog(scratch_path(spark, "log"))
    root, checkpoints = scratch_path(spark, "lake"), scratch_path(spark, "checkpoint")
    orders = SHOP["orders"](spark, sf_dir)
    log.append(envelope.encode(orders.where("status <> 'F'"), spec, PREFIX))
    landing.backfill(spark, spec, log, root, checkpoints, PREFIX)
    landing.backfill(spark, spec, log, root, checkpoints, PREFIX)
    log.append(envelope.encode(orders.where("status = 'F'"), spec, PREFIX))
    landing.backfill(spark, spec, log, root, checkpoints, PREFIX)
    return kpi.count_by(lake.load_dataset(spark, spec.lake_path(root), spec), "status", "orders")


@query
def followed_orders(spark, sf_dir):
    """A stream that starts at the end of the log lands only what comes later."""
    spec = catalog.ORDERS
    log = FileLog(scratch_path(spark, "log"))
    root, checkpoints = scratch_path(spark, "lake"), scratch_path(spark, "checkpoint")
    orders = SHOP["orders"](spark, sf_dir)
    for status in ("F", "O", "P"):
        log.append(envelope.encode(orders.where(F.col("status") == status), spec, PREFIX))
        landing.land_dataset(
            spark, spec, log, root, checkpoints, PREFIX, sinks.ONCE, starting=FOLLOW_OFFSETS
        ).awaitTermination()
    return kpi.count_by(lake.load_dataset(spark, spec.lake_path(root), spec), "status", "orders")


def _numbered_orders(spark, sf_dir) -> DataFrame:
    """Messages of orders in three partitions, with offsets in the order of their ids."""
    messages = envelope.encode(SHOP["orders"](spark, sf_dir), catalog.ORDERS, PREFIX)
    order_id = F.get_json_object(F.col("key").cast("string"), "$.order_id").cast("long")
    placed = messages.withColumn("partition", F.pmod(order_id, F.lit(3)).cast("int"))
    return offsets.in_order(placed, order_id)


@query
def log_between_offsets(spark, sf_dir):
    """The middle half of each partition of a log, read between offsets."""
    log, topic = FileLog(scratch_path(spark, "log")), catalog.ORDERS.topic(PREFIX)
    log.append(_numbered_orders(spark, sf_dir))
    marks = offsets.marks(log.messages(spark, topic)).collect()
    starting, ending = (
        json.dumps({topic: {r.partition: r.first + (r.end - r.first) * part // 4 for r in marks}})
        for part in (1, 3)
    )
    rows = log.read(spark, topic, starting, ending).transform(envelope.decode, catalog.ORDERS)
    return rows.select("order_id", "status")


@query
def log_missing_offsets(spark, sf_dir):
    """Stretches of a log that are gone: the messages of orders in process."""
    log, topic = FileLog(scratch_path(spark, "log")), catalog.ORDERS.topic(PREFIX)
    messages = _numbered_orders(spark, sf_dir)
    status = F.get_json_object(F.col("value").cast("string"), "$.after.status")
    log.append(messages.where(status != "P"))
    return offsets.missing(log.messages(spark, topic), offsets.ranges(messages))


@query
def ledger_resumed_orders(spark, sf_dir):
    """A reader takes a growing log in turns; each turn fails once before it is noted."""
    spec, topic = catalog.ORDERS, catalog.ORDERS.topic(PREFIX)
    log = FileLog(scratch_path(spark, "log"), partitions=4)
    ledger, root = offsets.Ledger(scratch_path(spark, "ledger")), scratch_path(spark, "taken")
    orders = SHOP["orders"](spark, sf_dir)
    for turn, status in enumerate(("F", "O", "P")):
        log.append(envelope.encode(orders.where(F.col("status") == status), spec, PREFIX))
        for _ in range(2):
            rows, wanted = ledger.take(log.messages(spark, topic), "reader", turn)
            rows.write.mode("overwrite").parquet(f"{root}/turn={turn}")
        ledger.note(wanted, "reader", turn)
    taken = spark.read.schema(LOG_SCHEMA).parquet(root).transform(envelope.decode, spec)
    return kpi.count_by(taken, "status", "orders")


@query
def all_datasets_landed(spark, sf_dir):
    """Nine datasets and the audit from one mixed log, side by side; rows and newest file count."""
    log = FileLog(scratch_path(spark, "log"))
    log.append(_mixed_messages(spark, sf_dir))
    root, checkpoints = scratch_path(spark, "lake"), scratch_path(spark, "checkpoint")
    landing.run_all(
        spark, log, root, checkpoints, PREFIX, trigger=sinks.ONCE, starting=BACKFILL_OFFSETS
    )
    rows = [
        frame.agg(F.lit(name).alias("dataset"), F.count("*").alias("rows"))
        for name, frame in dashboard.load_lake(spark, root).items()
    ]
    rows = reduce(DataFrame.unionAll, rows)
    # The existence probe answers in the driver, once per dataset.
    filled = [spec.name for spec in DATASETS if lake.has_data(spark, spec.lake_path(root))]
    return rows.withColumn("has_data", F.col("dataset").isin(*filled))


# ---------------------------------------------------------------- rules


@query
def line_totals(spark, sf_dir):
    items = rules.with_line_total(SHOP["order_items"](spark, sf_dir))
    return items.select("order_item_id", "product_id", "quantity", "line_total")


@query
def order_rollup(spark, sf_dir):
    return rules.order_rollup(SHOP["order_items"](spark, sf_dir))


@query
def total_reconciliation(spark, sf_dir):
    return rules.order_total_mismatches(
        SHOP["orders"](spark, sf_dir), SHOP["order_items"](spark, sf_dir)
    )


@query
def payment_reconciliation(spark, sf_dir):
    return rules.payment_amount_mismatches(
        SHOP["payments"](spark, sf_dir), SHOP["orders"](spark, sf_dir)
    )


@query
def orders_with_customer(spark, sf_dir):
    return rules.orders_with_customer(
        SHOP["orders"](spark, sf_dir), SHOP["customers"](spark, sf_dir)
    )


@query
def payment_lag(spark, sf_dir):
    return rules.payment_lag(SHOP["payments"](spark, sf_dir), SHOP["orders"](spark, sf_dir))


@query
def bucketed_reconciliation(spark, sf_dir):
    """Orders, lines and payments kept in buckets of the order, reconciled without a shuffle."""
    frames = {}
    for name, frame in shop(spark, sf_dir, "orders", "order_items", "payments").items():
        path = scratch_path(spark, name)
        kept = f"{name}_{path.rpartition('-')[2]}"
        buckets.land_bucketed(frame, kept, path, "order_id", BUCKETS)
        frames[name] = spark.table(kept)
    totals = rules.order_total_mismatches(frames["orders"], frames["order_items"])
    paid = rules.payment_amount_mismatches(frames["payments"], frames["orders"])
    lags = rules.payment_lag(frames["payments"], frames["orders"])
    return reduce(DataFrame.unionAll, [
        totals.select(F.lit("order total").alias("check"), F.col("order_id").alias("key"), "total_amount", F.col("items_total").alias("other")),
        paid.select(F.lit("payment"), "payment_id", "total_amount", "amount"),
        lags.select(F.lit("lag"), "payment_id", F.lit(None).cast("double"), F.col("lag_minutes").cast("double")),
    ])


@query
def payment_lag_streamed(spark, sf_dir):
    """The same from the messages of orders and payments, joined as streams."""
    log, out, checkpoint = (scratch_path(spark, name) for name in ("log", "lags", "checkpoint"))
    log, specs = FileLog(log), (catalog.PAYMENTS, catalog.ORDERS)
    for spec in specs:
        log.append(envelope.encode(SHOP[spec.name](spark, sf_dir), spec, PREFIX))
    rows = [landing.lake_rows(spark, spec, log, PREFIX, BACKFILL_OFFSETS) for spec in specs]
    pairs = payment_lag_stream(*rows)
    writer = pairs.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(**sinks.ONCE).start(out).awaitTermination()
    return spark.read.schema(pairs.schema).parquet(out)


@query
def ticket_resolution_minutes(spark, sf_dir):
    tickets = rules.with_resolution_minutes(
        SHOP["support_tickets"](spark, sf_dir), "created_at", "resolved_at", "minutes"
    )
    return tickets.select("ticket_id", "minutes", "resolution_time_minutes")


@query
def shipping_minutes(spark, sf_dir):
    """Minutes from order to shipping of every line; lines shipped before their order are negative."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    placed = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    timed = rules.with_resolution_minutes(joined, "o_orderdate", "l_shipdate", "minutes")
    return timed.groupBy("minutes").agg(F.count("*").alias("lines"))


@query
def previous_step(spark, sf_dir):
    events = SHOP["web_events"](spark, sf_dir).withColumn(
        "page_url", F.concat(F.lit("https://example.com/"), F.col("event_type"))
    )
    linked = rules.with_previous(
        events, "session_id", "event_timestamp", "event_id", "page_url", "referrer_url"
    )
    return linked.select("event_id", "session_id", "page_url", "referrer_url")


@query
def previous_step_by_user(spark, sf_dir):
    """Sessions that span the month, cut into days, hours and minutes on the way."""
    linked = rules.with_previous(
        SHOP["web_events"](spark, sf_dir),
        "customer_id",
        "event_timestamp",
        "event_id",
        "event_type",
        "before",
        first=None,
        cells=("day", "hour", "minute"),
    )
    return linked.select("event_id", "before")


@query
def month_tags(spark, sf_dir):
    tagged = rules.with_month_tag(SHOP["marketing_spend"](spark, sf_dir), "spend_date")
    return comparable(tagged.select("spend_id", "month_tag", "day_start"))


@query
def pk_violations(spark, sf_dir):
    return quality.duplicate_keys(SHOP["order_items"](spark, sf_dir), "order_item_id")


@query
def unique_email_violations(spark, sf_dir):
    return quality.duplicate_keys(SHOP["customers"](spark, sf_dir), "email")


@query
def fk_orphans(spark, sf_dir):
    """Every reference of the source tables; tickets refer to orders that may not exist."""
    frames = shop(spark, sf_dir)
    reports = []
    for child, table_rules in quality.SOURCE_RULES.items():
        for column, (parent, key) in table_rules.references.items():
            lost = quality.orphans(frames[child], column, frames[parent], key)
            reports.append(
                lost.select(
                    F.lit(f"{child}.{column}").alias("reference"),
                    F.col(column).alias("key"),
                    "rows",
                )
            )
    return reduce(DataFrame.unionAll, reports)


@query
def null_violations(spark, sf_dir):
    """Columns of tickets that may not be missing, were they all required."""
    tickets = SHOP["support_tickets"](spark, sf_dir)
    checked = ("ticket_id", "order_id", "resolved_at")
    return quality.violations(tickets, {f"{c} is null": quality.missing(c) for c in checked})


@query
def domain_violations(spark, sf_dir):
    """Text sizes and money, with limits tight enough to be broken."""
    items = SHOP["order_items"](spark, sf_dir).withColumn("large", F.col("total_price") * 1000)
    return quality.violations(
        items,
        {
            "order_item_id over 6 characters": quality.too_long("order_item_id", 6),
            "product_id over 36 characters": quality.too_long("product_id", 36),
            "total_price is no decimal(10,2)": quality.no_money("total_price"),
            "large is no decimal(10,2)": quality.no_money("large"),
        },
    )


@query
def source_rule_violations(spark, sf_dir):
    """All row-level rules of all source tables, one pass per table."""
    reports = [
        quality.table_violations(frame, quality.SOURCE_RULES[name]).withColumn(
            "dataset", F.lit(name)
        )
        for name, frame in shop(spark, sf_dir).items()
        if name in quality.SOURCE_RULES
    ]
    return reduce(DataFrame.unionByName, reports)


@query
def insert_ignore(spark, sf_dir):
    """Lines to add to the returned ones: a taken key stays, the first line of a new key wins."""
    lines = table(spark, sf_dir, "lineitem")
    key, order = ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    returned = lines.where("l_returnflag = 'R'")
    return insert.insert_ignore(returned, lines, key, [*order, "l_extendedprice"])


@query
def insert_ignore_two_keys(spark, sf_dir):
    """Lines under two unique columns at once: line number of the order, and part of the supplier."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"),
        F.concat_ws("-", "l_partkey", "l_suppkey").alias("supply"),
        "l_shipdate",
        "l_extendedprice",
        "l_returnflag",
    )
    return insert.insert_ignore_unique(
        lines.where("l_returnflag = 'R'"),
        lines,
        "line",
        ["supply"],
        ["l_shipdate", "line", "supply", "l_extendedprice"],
    ).select("line", "supply")


@query
def insert_ignore_stream(spark, sf_dir):
    """Lines into a table with a line of each order, as a stream that is replayed from its start."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    source, target = scratch_path(spark, "lines"), scratch_path(spark, "table")
    wanted = inserts.InsertTable(target, lines.schema, ["l_orderkey"], ["l_shipdate", "l_linenumber"])

    def land(checkpoint: str) -> None:
        stream = spark.readStream.schema(lines.schema).parquet(source)
        wanted.insert_stream(stream, checkpoint, trigger=sinks.ONCE).awaitTermination()

    checkpoint = scratch_path(spark, "checkpoint")
    for flag in ("R", "A", "N"):
        lines.where(F.col("l_returnflag") == flag).write.mode("append").parquet(source)
        land(checkpoint)
    land(scratch_path(spark, "checkpoint"))
    return wanted.rows(spark)


@query
def seeded_if_empty(spark, sf_dir):
    """Customers seeded twice: the second time the target is not empty, and nothing is added."""
    root = scratch_path(spark, "seed")
    customers = SHOP["customers"](spark, sf_dir)
    for _ in range(2):
        target = lake.load_dataset(spark, root, customers.schema)
        insert.seed_if_empty(
            target, lambda: customers, lambda rows: rows.write.mode("append").parquet(root)
        )
    return lake.load_dataset(spark, root, customers.schema).select("customer_id", "email")


def run(name: str) -> Query:
    """A registered query on a configured session."""

    def configured(spark, sf_dir):
        return QUERIES[name](configure(spark), sf_dir)

    return configured
