"""The shop's datasets, made of the benchmark tables.

Each mapping turns whole tables into the columns of one dataset; nothing is
sampled, and no row is made up. Times stay ``timestamp_ntz``, as in the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

# The columns of the tables. Stating them saves opening files to plan a query.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _mapped(name: str, columns: tuple[str, ...], spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, name).selectExpr(*columns)


def _at(base_millis: int, key: str, step_millis: int) -> str:
    """A time with millis that differs from row to row."""
    return f"CAST(timestamp_millis({base_millis} + {key} * {step_millis}) AS timestamp_ntz)"


def _minutes_after(time: str, minutes: str) -> str:
    return f"{time} + make_dt_interval(0, 0, CAST({minutes} AS int))"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    named = table(spark, sf_dir, "customer").join(nation, "c_nationkey", "left")
    return named.selectExpr(
        "CAST(c_custkey AS string) AS customer_id",
        "split_part(c_name, '#', 1) AS first_name",
        "split_part(c_name, '#', 2) AS last_name",
        # Neighbours in one segment share an address.
        "concat(lower(c_mktsegment), '.', c_custkey - c_custkey % 2, '@example.com') AS email",
        "concat(c_nationkey, '-', c_custkey) AS phone",
        "concat(c_mktsegment, ' Street ', c_custkey) AS address",
        "concat('City ', c_nationkey) AS city",
        "n_name AS country",
        f"{_at(1700000000000, 'c_custkey', 789)} AS registration_date",
    )


PRODUCTS = (
    "CAST(p_partkey AS string) AS product_id",
    "p_name AS name",
    "p_type AS category",
    "p_retailprice AS price",
    "p_retailprice / 2 AS cost",
    "CAST(p_size AS bigint) AS stock_quantity",
    f"{_at(1650000000000, 'p_partkey', 1013)} AS created_at",
)
ORDERS = (
    "CAST(o_orderkey AS string) AS order_id",
    "CAST(o_custkey AS string) AS customer_id",
    "o_orderdate AS order_date",
    "o_totalprice AS total_amount",
    "o_orderstatus AS status",
    "concat('Depot ', o_orderpriority) AS shipping_address",
)
ORDER_ITEMS = (
    "concat(l_orderkey, '-', l_linenumber) AS order_item_id",
    "CAST(l_orderkey AS string) AS order_id",
    "CAST(l_partkey AS string) AS product_id",
    "CAST(l_quantity AS bigint) AS quantity",
    "l_extendedprice / l_quantity AS unit_price",
    "l_extendedprice AS total_price",
)
# One payment per order: the minutes between them follow the price, and a
# payment of an order in status P is cut to whole units.
_PAID_AT = _minutes_after("o_orderdate", "floor(o_totalprice / 5000)")
PAYMENTS = (
    "concat('pay-', o_orderkey) AS payment_id",
    "CAST(o_orderkey AS string) AS order_id",
    "IF(o_orderstatus = 'P', CAST(floor(o_totalprice) AS double), o_totalprice) AS amount",
    "o_orderpriority AS payment_method",
    "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'failed' END "
    "AS status",
    "concat('txn_', o_orderkey) AS transaction_id",
    f"{_PAID_AT} AS created_at",
    f"{_PAID_AT} AS updated_at",
)
# One ticket per event: errors stay open, views refer to no order, and some of the others
# to an order that is not there.
_TICKET_AT = "CAST(date_trunc('second', ts) AS timestamp_ntz)"
_TICKET_MINUTES = "IF(event_type <> 'error', floor(value), NULL)"
SUPPORT_TICKETS = (
    "concat('t', event_id) AS ticket_id",
    "CAST(user_id AS string) AS customer_id",
    "IF(event_type <> 'view', CAST(event_id * 2 AS string), NULL) AS order_id",
    "event_type AS subject",
    "props AS description",
    "IF(event_type = 'error', 'open', 'closed') AS status",
    "CASE event_type WHEN 'error' THEN 'urgent' WHEN 'purchase' THEN 'high' "
    "WHEN 'signup' THEN 'medium' ELSE 'low' END AS priority",
    "concat('agent ', user_id) AS assigned_to",
    f"{_TICKET_AT} AS created_at",
    f"{_minutes_after(_TICKET_AT, _TICKET_MINUTES)} AS resolved_at",
    f"{_TICKET_MINUTES} AS resolution_time_minutes",
)
# One incident per supplier: a negative balance keeps it open.
_STARTED = _at(1704067200000, "s_suppkey", 60013)
_INCIDENT_MINUTES = "IF(s_acctbal >= 0, s_nationkey * 7 + 5, NULL)"
_ENDED = _minutes_after(_STARTED, _INCIDENT_MINUTES)
INCIDENTS = (
    "concat('inc-', s_suppkey) AS incident_id",
    "s_name AS title",
    "concat('Trouble at ', s_name) AS description",
    "concat('service ', s_nationkey) AS service",
    "CASE WHEN s_acctbal < 0 THEN 'critical' WHEN s_acctbal < 2500 THEN 'high' "
    "WHEN s_acctbal < 5000 THEN 'medium' ELSE 'low' END AS severity",
    "IF(s_acctbal < 0, 'open', 'closed') AS status",
    f"{_STARTED} AS start_time",
    f"{_ENDED} AS end_time",
    f"CAST({_INCIDENT_MINUTES} AS bigint) AS resolution_time_minutes",
    "IF(s_acctbal < 0, 'ongoing', NULL) AS impact_description",
    f"{_STARTED} AS created_at",
    f"coalesce({_ENDED}, {_STARTED}) AS updated_at",
)
MARKETING_SPEND = (
    "concat(l_orderkey, '-', l_linenumber, '-', l_partkey) AS spend_id",
    "concat('Campaign_', l_linestatus, date_format(l_shipdate, '_yyyyMM')) AS campaign_name",
    "l_returnflag AS channel",
    "CAST(l_shipdate AS date) AS spend_date",
    "l_extendedprice AS amount",
    "IF(l_linestatus = 'F', 'USD', 'EUR') AS currency",
    "l_partkey AS impressions",
    "CAST(l_quantity AS bigint) AS clicks",
    "CAST(l_linenumber AS bigint) AS conversions",
    "CAST(CAST(l_shipdate AS date) AS timestamp_ntz) AS created_at",
)
# A session is what one user does on one day.
WEB_EVENTS = (
    "CAST(event_id AS string) AS event_id",
    "concat(user_id, '/', date_format(ts, 'yyyy-MM-dd')) AS session_id",
    "CAST(user_id AS string) AS customer_id",
    "event_type",
    "ts AS event_timestamp",
)

SHOP: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": customers,
    "products": partial(_mapped, "part", PRODUCTS),
    "orders": partial(_mapped, "orders", ORDERS),
    "order_items": partial(_mapped, "lineitem", ORDER_ITEMS),
    "payments": partial(_mapped, "orders", PAYMENTS),
    "support_tickets": partial(_mapped, "events", SUPPORT_TICKETS),
    "incidents": partial(_mapped, "supplier", INCIDENTS),
    "marketing_spend": partial(_mapped, "lineitem", MARKETING_SPEND),
    "web_events": partial(_mapped, "events", WEB_EVENTS),
}

# The event types of the tables, in the order of a visit.
VISIT_STEPS = ("view", "click", "signup", "purchase")
