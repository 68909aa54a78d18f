"""The nine datasets as data: key, columns, and how each column travels on the wire."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# How a column is written on the wire, and what it becomes in the lake.
WIRE_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "epoch_ms": T.LongType(),
    "epoch_days": T.LongType(),
    "iso_ts": T.StringType(),
}
LANDED_TYPES = {
    **WIRE_TYPES,
    "epoch_ms": T.TimestampType(),
    "epoch_days": T.DateType(),
    "iso_ts": T.TimestampType(),
}
STAGING_SUFFIX = {"epoch_ms": "_ms", "epoch_days": "_days"}

PARTITION_COLUMNS = ("year", "month", "day", "hour")


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "string"

    @property
    def staged_name(self) -> str:
        """Name between decoding and conversion: epoch values carry their unit."""
        return self.name + STAGING_SUFFIX.get(self.kind, "")


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    key: str
    fields: tuple[Field, ...]
    # CDC messages wrap the row as {"op", "after"}; clicks are flat.
    change_events: bool = True
    # Registered tables are replayed from the start of the log; clicks are not.
    backfilled: bool = True

    def topic(self, prefix: str) -> str:
        """Topic of this dataset under a connector prefix; clicks have their own topic."""
        return f"{prefix}.public.{self.name}" if self.change_events else self.name

    def lake_path(self, root: str) -> str:
        return f"{root.rstrip('/')}/raw/{self.name}"

    def checkpoint_path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.name}"

    def row_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, WIRE_TYPES[f.kind]) for f in self.fields])

    def message_schema(self) -> T.StructType:
        if not self.change_events:
            return self.row_schema()
        return T.StructType(
            [T.StructField("op", T.StringType()), T.StructField("after", self.row_schema())]
        )

    def landed_fields(self) -> list[Field]:
        """Lake order: converted epoch columns follow the plain ones."""
        plain = [f for f in self.fields if f.kind not in STAGING_SUFFIX]
        return plain + [f for f in self.fields if f.kind in STAGING_SUFFIX]

    def landed_schema(self) -> T.StructType:
        """Schema of the lake folder, partition columns included."""
        head = [T.StructField("kafka_timestamp", T.TimestampType())]
        if self.change_events:
            head.append(T.StructField("op", T.StringType()))
        body = [T.StructField(f.name, LANDED_TYPES[f.kind]) for f in self.landed_fields()]
        tail = [T.StructField("_ingested_at", T.TimestampType())]
        tail += [T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS]
        return T.StructType(head + body + tail)


def dataset(name: str, columns: str, **options) -> DatasetSpec:
    """Spec from ``"key, column kind, …"``; the kind defaults to string, the key comes first."""
    fields = tuple(Field(*column.split()) for column in columns.split(","))
    return DatasetSpec(name, fields[0].name, fields, **options)


# The wire contract of the source tables, column by column.
CUSTOMERS = dataset(
    "customers",
    "customer_id, first_name, last_name, email, phone, address, city, country, "
    "registration_date epoch_ms",
)
PRODUCTS = dataset(
    "products",
    "product_id, name, category, price double, cost double, stock_quantity long, "
    "created_at epoch_ms",
)
ORDERS = dataset(
    "orders",
    "order_id, customer_id, order_date epoch_ms, total_amount double, status, shipping_address",
)
ORDER_ITEMS = dataset(
    "order_items",
    "order_item_id, order_id, product_id, quantity long, unit_price double, total_price double",
)
PAYMENTS = dataset(
    "payments",
    "payment_id, order_id, amount double, payment_method, status, transaction_id, "
    "created_at epoch_ms, updated_at epoch_ms",
)
SUPPORT_TICKETS = dataset(
    "support_tickets",
    "ticket_id, customer_id, order_id, subject, description, status, priority, assigned_to, "
    "created_at epoch_ms, resolved_at epoch_ms, resolution_time_minutes long",
)
INCIDENTS = dataset(
    "incidents",
    "incident_id, title, description, service, severity, status, start_time epoch_ms, "
    "end_time epoch_ms, resolution_time_minutes long, impact_description, "
    "created_at epoch_ms, updated_at epoch_ms",
)
MARKETING_SPEND = dataset(
    "marketing_spend",
    "spend_id, campaign_name, channel, spend_date epoch_days, amount double, currency, "
    "impressions long, clicks long, conversions long, created_at epoch_ms",
)
WEB_EVENTS = dataset(
    "web_events",
    "event_id, session_id, customer_id, event_type, event_timestamp iso_ts",
    change_events=False,
    backfilled=False,
)

CHANGE_DATASETS = (
    CUSTOMERS,
    PRODUCTS,
    ORDERS,
    ORDER_ITEMS,
    PAYMENTS,
    SUPPORT_TICKETS,
    INCIDENTS,
    MARKETING_SPEND,
)
DATASETS = (WEB_EVENTS, *CHANGE_DATASETS)
