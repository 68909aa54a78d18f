"""The same results in plain SQL, written against the benchmark tables alone.

``SHOP_SQL`` states the dataset mapping of ``shop.py`` a second time; each query
starts with the mappings it names.
"""

from __future__ import annotations

import re

SHOP_SQL = {
    "customers": """
        SELECT c_custkey::VARCHAR AS customer_id,
               split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               lower(c_mktsegment) || '.' || (c_custkey - c_custkey % 2) || '@example.com' AS email,
               c_nationkey || '-' || c_custkey AS phone,
               c_mktsegment || ' Street ' || c_custkey AS address,
               'City ' || c_nationkey AS city,
               n_name AS country,
               epoch_ms(1700000000000 + c_custkey * 789) AS registration_date
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "products": """
        SELECT p_partkey::VARCHAR AS product_id, p_name AS name, p_type AS category,
               p_retailprice AS price, p_retailprice / 2 AS cost,
               p_size::BIGINT AS stock_quantity,
               epoch_ms(1650000000000 + p_partkey * 1013) AS created_at
        FROM part""",
    "orders": """
        SELECT o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS customer_id,
               o_orderdate AS order_date, o_totalprice AS total_amount,
               o_orderstatus AS status, 'Depot ' || o_orderpriority AS shipping_address
        FROM orders""",
    "order_items": """
        SELECT l_orderkey || '-' || l_linenumber AS order_item_id,
               l_orderkey::VARCHAR AS order_id, l_partkey::VARCHAR AS product_id,
               l_quantity::BIGINT AS quantity, l_extendedprice / l_quantity AS unit_price,
               l_extendedprice AS total_price
        FROM lineitem""",
    "payments": """
        SELECT 'pay-' || o_orderkey AS payment_id, o_orderkey::VARCHAR AS order_id,
               CASE WHEN o_orderstatus = 'P' THEN floor(o_totalprice) ELSE o_totalprice END
                   AS amount,
               o_orderpriority AS payment_method,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                    ELSE 'failed' END AS status,
               'txn_' || o_orderkey AS transaction_id,
               o_orderdate + to_minutes(floor(o_totalprice / 5000)::BIGINT) AS created_at,
               o_orderdate + to_minutes(floor(o_totalprice / 5000)::BIGINT) AS updated_at
        FROM orders""",
    "support_tickets": """
        SELECT 't' || event_id AS ticket_id, user_id::VARCHAR AS customer_id,
               CASE WHEN event_type <> 'view' THEN (event_id * 2)::VARCHAR END AS order_id,
               event_type AS subject, props AS description,
               CASE WHEN event_type = 'error' THEN 'open' ELSE 'closed' END AS status,
               CASE event_type WHEN 'error' THEN 'urgent' WHEN 'purchase' THEN 'high'
                    WHEN 'signup' THEN 'medium' ELSE 'low' END AS priority,
               'agent ' || user_id AS assigned_to,
               date_trunc('second', ts) AS created_at,
               CASE WHEN event_type <> 'error'
                    THEN date_trunc('second', ts) + to_minutes(floor(value)::BIGINT) END
                   AS resolved_at,
               CASE WHEN event_type <> 'error' THEN floor(value)::BIGINT END
                   AS resolution_time_minutes
        FROM events""",
    "incidents": """
        SELECT incident_id, title, description, service, severity, status,
               start_time, start_time + to_minutes(minutes) AS end_time,
               minutes AS resolution_time_minutes, impact_description,
               start_time AS created_at,
               coalesce(start_time + to_minutes(minutes), start_time) AS updated_at
        FROM (SELECT 'inc-' || s_suppkey AS incident_id, s_name AS title,
                     'Trouble at ' || s_name AS description,
                     'service ' || s_nationkey AS service,
                     CASE WHEN s_acctbal < 0 THEN 'critical' WHEN s_acctbal < 2500 THEN 'high'
                          WHEN s_acctbal < 5000 THEN 'medium' ELSE 'low' END AS severity,
                     CASE WHEN s_acctbal < 0 THEN 'open' ELSE 'closed' END AS status,
                     epoch_ms(1704067200000 + s_suppkey * 60013) AS start_time,
                     CASE WHEN s_acctbal >= 0 THEN (s_nationkey * 7 + 5)::BIGINT END AS minutes,
                     CASE WHEN s_acctbal < 0 THEN 'ongoing' END AS impact_description
              FROM supplier)""",
    "marketing_spend": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS spend_id,
               'Campaign_' || l_linestatus || '_' || strftime(l_shipdate, '%Y%m')
                   AS campaign_name,
               l_returnflag AS channel, l_shipdate::DATE AS spend_date,
               l_extendedprice AS amount,
               CASE WHEN l_linestatus = 'F' THEN 'USD' ELSE 'EUR' END AS currency,
               l_partkey AS impressions, l_quantity::BIGINT AS clicks,
               l_linenumber::BIGINT AS conversions,
               l_shipdate::DATE::TIMESTAMP AS created_at
        FROM lineitem""",
    "web_events": """
        SELECT event_id::VARCHAR AS event_id,
               user_id || '/' || strftime(ts, '%Y-%m-%d') AS session_id,
               user_id::VARCHAR AS customer_id, event_type, ts AS event_timestamp
        FROM events""",
}

# The landed columns of the rows a stream or a round trip gives back.
TIME_COLUMNS = {
    "orders": "order_date",
    "payments": "created_at",
    "web_events": "event_timestamp",
    "support_tickets": "created_at",
    "incidents": "created_at",
    "marketing_spend": "spend_date",
}


def shop_query(body: str) -> str:
    """The query, preceded by the mapping of every ``shop_<dataset>`` it names."""
    names = [n for n in SHOP_SQL if re.search(rf"\bshop_{n}\b", body)]
    mappings = ",\n".join(f"shop_{n} AS ({SHOP_SQL[n]})" for n in names)
    if not mappings:
        return body
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {mappings},\n{body.lstrip()[5:]}"
    return f"WITH {mappings}\n{body}"


def total(column: str) -> str:
    return f"coalesce(sum({column}::DECIMAL(18,2))::DOUBLE, 0.0)"


def mean(column: str) -> str:
    return f"coalesce(sum({column}::DECIMAL(18,2))::DOUBLE / nullif(count({column}), 0), 0.0)"


def count_by(relation: str, key: str, name: str) -> str:
    return f"SELECT {key}, count(*) AS {name} FROM {relation} WHERE {key} IS NOT NULL GROUP BY {key}"


def sum_by(relation: str, key: str, amount: str, name: str) -> str:
    return (
        f"SELECT {key}, {total(amount)} AS {name} FROM {relation} "
        f"WHERE {key} IS NOT NULL GROUP BY {key}"
    )


def recent(relation: str, time: str, days: int) -> str:
    return (
        f"SELECT * FROM {relation} "
        f"WHERE {time} >= (SELECT max({time}) FROM {relation}) - INTERVAL {days} DAY"
    )


def bands(relation: str, amount: str, edges: list[tuple[str, str, str]]) -> str:
    """Edges are (label, lower condition, upper condition)."""
    cases = " ".join(f"WHEN {low} AND {high} THEN '{label}'" for label, low, high in edges)
    labels = ", ".join(f"('{label}')" for label, _, _ in edges)
    return f"""
        SELECT band, count(found) AS orders
        FROM (VALUES {labels}) AS b(band)
        LEFT JOIN (SELECT CASE {cases} END AS found FROM {relation}) ON found = band
        GROUP BY band"""


def money_text(column: str) -> str:
    return f"'$' || format('{{:,.2f}}', {column})"


def count_text(column: str) -> str:
    return f"format('{{:,}}', {column})"


OVERVIEW = f"""
    SELECT (SELECT count(*) FROM shop_orders) AS orders,
           (SELECT {total('total_amount')} FROM shop_orders) AS revenue,
           (SELECT {mean('total_amount')} FROM shop_orders) AS average_order_value,
           (SELECT count(*) FROM shop_payments WHERE status = 'completed') AS completed_payments,
           (SELECT count(*) FROM shop_customers) AS customers,
           (SELECT count(*) FROM shop_products) AS products"""

MINUTE = "'%Y-%m-%d %H:%M'"

HEALTH = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, count(*) AS rows, "
    f"coalesce(strftime(coalesce({', '.join(f'max({c})' for c in columns)}), {MINUTE}), 'n/a') "
    f"AS latest FROM shop_{name}"
    for name, columns in {
        "orders": ["order_date"],
        "payments": ["created_at", "updated_at"],
        "web_events": ["event_timestamp"],
        "support_tickets": ["created_at", "resolved_at"],
        "incidents": ["updated_at", "created_at"],
    }.items()
)

WINDOWS = " UNION ALL ".join(
    f"SELECT '{label}' AS window, count(*) AS orders, {total('total_amount')} AS revenue "
    f"FROM ({source})"
    for label, source in {
        "All": "SELECT * FROM shop_orders",
        "365 days": recent("shop_orders", "order_date", 365),
        "90 days": recent("shop_orders", "order_date", 90),
        "30 days": recent("shop_orders", "order_date", 30),
        "7 days": recent("shop_orders", "order_date", 7),
    }.items()
)

REPORT_FILTERS = {
    "orders": " AND status IN ('F', 'O')",
    "web_events": " AND event_type = 'purchase'",
}
REPORT_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, count(*) AS rows FROM "
    + (
        f"({recent(f'shop_{name}', TIME_COLUMNS[name], 30)}{REPORT_FILTERS.get(name, '')})"
        if name in TIME_COLUMNS
        else f"shop_{name}"
    )
    for name in SHOP_SQL
)

CHANGE_OP = "CASE status WHEN 'F' THEN 'c' WHEN 'O' THEN 'u' ELSE 'd' END"
ORDER_MESSAGE = f"""
    SELECT json_object('order_id', order_id)::VARCHAR AS message_key,
           json_object('op', {CHANGE_OP}, 'after', CASE WHEN status <> 'P' THEN json_object(
               'order_id', order_id, 'customer_id', customer_id,
               'order_date', epoch_ms(order_date), 'total_amount', total_amount,
               'status', status, 'shipping_address', shipping_address) END)::VARCHAR AS message,
           'shop.public.orders' AS topic
    FROM shop_orders"""

ISO = (
    "strftime(ts, '%Y-%m-%dT%H:%M:%S') || "
    "CASE WHEN strftime(ts, '%f') = '000000' THEN '' ELSE strftime(ts, '.%f') END"
)

STRAY = """
    SELECT 'shop.public.returns_' || event_type AS topic, 'c' AS op,
           json_object('event_id', event_id, 'event_type', event_type)::VARCHAR AS after_json
    FROM events"""

REFERENCES = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("support_tickets", "customer_id", "customers", "customer_id"),
    ("support_tickets", "order_id", "orders", "order_id"),
]
ORPHANS = " UNION ALL ".join(
    f"SELECT '{child}.{column}' AS reference, {column} AS key, count(*) AS rows "
    f"FROM shop_{child} WHERE {column} IS NOT NULL "
    f"AND {column} NOT IN (SELECT {key} FROM shop_{parent}) GROUP BY {column}"
    for child, column, parent, key in REFERENCES
)


def rule_rows(relation: str, rules: dict[str, str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {test}) AS rows{extra} FROM {relation}"
        for name, test in rules.items()
    )


def _null(column: str) -> dict[str, str]:
    return {f"{column} is null": f"{column} IS NULL"}


def _size(column: str, limit: int) -> dict[str, str]:
    return {f"{column} over {limit} characters": f"length({column}) > {limit}"}


def _money(column: str) -> dict[str, str]:
    return {
        f"{column} is no decimal(10,2)": f"{column} IS NOT NULL AND "
        f"TRY_CAST({column} AS DECIMAL(10,2)) IS NULL"
    }


def _rules(key, required=(), sizes=None, money=()):
    checks = {}
    for column in (key, *required):
        checks |= _null(column)
    for column, limit in (sizes or {}).items():
        checks |= _size(column, limit)
    for column in money:
        checks |= _money(column)
    return checks


# The constraints of the source tables.
TABLE_RULES = {
    "customers": _rules(
        "customer_id",
        sizes={"customer_id": 36, "first_name": 100, "last_name": 100, "email": 255,
               "phone": 50, "city": 100, "country": 100},
    ),
    "products": _rules(
        "product_id", sizes={"product_id": 36, "name": 255, "category": 100},
        money=("price", "cost"),
    ),
    "orders": _rules(
        "order_id", sizes={"order_id": 36, "customer_id": 36, "status": 50},
        money=("total_amount",),
    ),
    "order_items": _rules(
        "order_item_id", sizes={"order_item_id": 36, "order_id": 36, "product_id": 36},
        money=("unit_price", "total_price"),
    ),
    "payments": _rules(
        "payment_id", ("amount",),
        {"payment_id": 36, "order_id": 36, "payment_method": 50, "status": 50,
         "transaction_id": 100},
        ("amount",),
    ),
    "incidents": _rules(
        "incident_id", ("title", "service", "start_time"),
        {"incident_id": 36, "title": 255, "service": 100, "severity": 20, "status": 20},
    ),
    "support_tickets": _rules(
        "ticket_id",
        sizes={"ticket_id": 36, "customer_id": 36, "order_id": 36, "subject": 255,
               "status": 50, "priority": 20, "assigned_to": 100},
    ),
    "marketing_spend": _rules(
        "spend_id", sizes={"spend_id": 36, "campaign_name": 255, "channel": 100, "currency": 3},
        money=("amount",),
    ),
}

def one_pass(relation: str, keys: dict[str, str], measures: str) -> str:
    charts = [
        f"SELECT '{name}' AS chart, ({key})::VARCHAR AS value, {measures} FROM {relation} "
        f"WHERE ({key}) IS NOT NULL GROUP BY 2"
        for name, key in keys.items()
    ]
    return " UNION ALL ".join(
        [*charts, f"SELECT 'all' AS chart, NULL AS value, {measures} FROM {relation}"]
    )


BODIES = {
    "orders_in_one_pass": one_pass(
        "(SELECT * FROM shop_orders WHERE status IS NOT NULL)",
        {
            "status": "status",
            "order_day": "order_date::DATE",
            "band": "CASE WHEN total_amount < 0 THEN NULL WHEN total_amount <= 100 THEN '0-100' "
            "WHEN total_amount <= 500 THEN '100-500' WHEN total_amount > 500 THEN '>500' END",
        },
        f"count(*) AS orders, {total('total_amount')} AS revenue, "
        f"{mean('total_amount')} AS average_order_value",
    ),
    "payments_in_one_pass": one_pass(
        "shop_payments",
        {"status": "status", "payment_method": "payment_method"},
        "count(*) AS payments, count(*) FILTER (WHERE status = 'completed') AS completed",
    ),
    "web_events_in_one_pass": one_pass(
        "(SELECT * FROM shop_web_events WHERE event_type IS NOT NULL)",
        {
            "event_type": "event_type",
            "event_hour": f"strftime(date_trunc('hour', event_timestamp), {MINUTE})",
        },
        "count(*) AS events",
    ),
    "overview_card": OVERVIEW,
    "overview_labels": f"""
        SELECT {count_text('orders')} AS orders, {money_text('revenue')} AS revenue,
               'Average order value: ' || {money_text('average_order_value')} AS revenue_note,
               {count_text('completed_payments')} AS completed_payments,
               {count_text('customers')} || ' / ' || {count_text('products')}
                   AS customers_products
        FROM ({OVERVIEW})""",
    "orders_count": "SELECT count(*) AS orders FROM shop_orders",
    "web_events_count": "SELECT count(*) AS web_events FROM shop_web_events",
    "revenue_total": f"SELECT {total('total_amount')} AS revenue FROM shop_orders",
    "average_order_value": f"SELECT {mean('total_amount')} AS average_order_value FROM shop_orders",
    "completed_payments": """
        SELECT count(*) AS completed_payments FROM shop_payments WHERE status = 'completed'""",
    "customer_and_product_counts": """
        SELECT (SELECT count(*) FROM shop_customers) AS customers,
               (SELECT count(*) FROM shop_products) AS products""",
    "orders_by_status": count_by("shop_orders", "status", "orders"),
    "revenue_by_day": f"""
        SELECT order_date::DATE AS order_day, {total('total_amount')} AS revenue
        FROM shop_orders WHERE order_date IS NOT NULL GROUP BY 1""",
    "revenue_by_day_rolled_up": f"""
        SELECT order_date::DATE AS order_day, {total('total_amount')} AS revenue
        FROM shop_orders WHERE order_date IS NOT NULL GROUP BY 1""",
    "visitors_estimated": """
        WITH newest AS (SELECT max(event_timestamp) AS t FROM shop_web_events)
        SELECT w.name AS "window", TRUE AS same_rows, count(*) AS events, TRUE AS sessions_near, TRUE AS customers_near
        FROM (VALUES ('All', 100000), ('365 days', 365), ('90 days', 90), ('30 days', 30), ('7 days', 7)) w(name, days), newest, shop_web_events
        WHERE date_trunc('hour', event_timestamp) >= date_trunc('hour', t - to_days(w.days))
        GROUP BY w.name""",
    "order_value_bands": bands(
        "shop_orders", "total_amount",
        [("0-100", "total_amount >= 0", "total_amount <= 100"),
         ("100-500", "total_amount > 100", "total_amount <= 500"),
         (">500", "total_amount > 500", "TRUE")],
    ),
    "order_value_bands_wide": bands(
        "shop_orders", "total_amount",
        [("0-100k", "total_amount >= 0", "total_amount <= 100000"),
         ("100k-250k", "total_amount > 100000", "total_amount <= 250000"),
         (">250k", "total_amount > 250000", "TRUE")],
    ),
    "balance_bands": bands(
        "customer", "c_acctbal",
        [("0-2500", "c_acctbal >= 0", "c_acctbal <= 2500"),
         ("2500-5000", "c_acctbal > 2500", "c_acctbal <= 5000"),
         (">5000", "c_acctbal > 5000", "TRUE")],
    ),
    "payment_success_rate": """
        SELECT coalesce(100.0::DOUBLE * count(*) FILTER (WHERE status = 'completed')
                        / nullif(count(*), 0), 0.0)::DOUBLE AS success_rate
        FROM shop_payments""",
    "success_caption": """
        SELECT 'Success rate: ' || printf('%.1f', coalesce(100.0 * count(*) FILTER (WHERE status = 'completed')
                        / nullif(count(*), 0), 0.0)::DOUBLE) || '%' AS caption
        FROM shop_payments""",
    "traffic_caption": """
        SELECT 'Sessions: ' || format('{:,}', count(DISTINCT session_id)) || ' | Purchase events: '
               || format('{:,}', count(*) FILTER (WHERE event_type = 'purchase')) AS caption
        FROM shop_web_events""",
    "payments_by_status": count_by("shop_payments", "status", "payments"),
    "payments_by_method": count_by("shop_payments", "payment_method", "payments"),
    "events_by_type": count_by("shop_web_events", "event_type", "events"),
    "hourly_events": """
        SELECT date_trunc('hour', event_timestamp) AS event_hour, count(*) AS events
        FROM shop_web_events WHERE event_timestamp IS NOT NULL GROUP BY 1""",
    "sessions_and_purchases": """
        SELECT count(DISTINCT session_id) AS sessions,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchases
        FROM shop_web_events""",
    "tickets_by_priority": count_by("shop_support_tickets", "priority", "tickets"),
    "incidents_by_severity": count_by("shop_incidents", "severity", "incidents"),
    "spend_by_channel": sum_by("shop_marketing_spend", "channel", "amount", "spend"),
    "balance_by_segment": sum_by("customer", "c_mktsegment", "c_acctbal", "balance"),
    "funnel_reach": """
        WITH depths AS (
            SELECT session_id, max(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2
                                   WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 END) AS depth
            FROM shop_web_events GROUP BY session_id),
        reached AS (
            SELECT step::INTEGER AS step, event_type,
                   (SELECT count(*) FROM depths WHERE depth >= step) AS sessions
            FROM (VALUES (1, 'view'), (2, 'click'), (3, 'signup'), (4, 'purchase'))
                 AS s(step, event_type))
        SELECT step, event_type, sessions,
               sessions::DOUBLE / first_value(sessions) OVER (ORDER BY step) AS share_of_first,
               sessions::DOUBLE / coalesce(lag(sessions) OVER (ORDER BY step), sessions)
                   AS share_of_previous
        FROM reached""",
    "latest_timestamps": f"""
        SELECT strftime(max(resolved_at), {MINUTE}) AS resolved,
               strftime(max(created_at), {MINUTE}) AS fallback, 'n/a' AS nothing
        FROM shop_support_tickets""",
    "dataset_health": HEALTH,
    "preview_orders": "SELECT * FROM orders LIMIT 20",
    "newest_files_rows": """
        SELECT o_orderkey, lpad((o_orderkey % 24)::VARCHAR, 2, '0') AS hour FROM orders
        WHERE o_orderkey % 24 >= 19""",
    "rows_by_hour": """
        SELECT '2024' AS year, '01' AS month, '02' AS day, lpad((o_orderkey % 24)::VARCHAR, 2, '0') AS hour, count(*) AS rows
        FROM orders GROUP BY ALL""",
    "compacted_orders": """
        SELECT o_orderkey, o_orderstatus, day, lpad((o_orderkey % 24)::VARCHAR, 2, '0') AS hour
        FROM orders, (VALUES ('02'), ('03')) d(day) WHERE day = '02' OR o_orderstatus = 'P'""",
    "preview_filtered": """
        SELECT lpad((o_orderkey % 24)::VARCHAR, 2, '0') AS hour, o_orderkey FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000
        ORDER BY hour DESC, o_orderkey LIMIT 30""",
    "recent_events_7d": recent("shop_web_events", "event_timestamp", 7),
    "recent_orders_by_window": WINDOWS,
    "recent_spend_30d": sum_by(
        f"({recent('shop_marketing_spend', 'spend_date', 30)})", "channel", "amount", "spend"
    ),
    "status_filtered": "SELECT * FROM shop_orders WHERE status IN ('F', 'P')",
    "event_type_filtered": """
        SELECT * FROM shop_web_events WHERE event_type IN ('purchase', 'signup')""",
    "priority_filtered": """
        SELECT ticket_id, priority, created_at, resolved_at FROM shop_support_tickets
        WHERE priority IN ('urgent', 'high')""",
    "status_options": "SELECT DISTINCT status FROM shop_orders WHERE status IS NOT NULL",
    "event_type_options": """
        SELECT DISTINCT event_type FROM shop_web_events WHERE event_type IS NOT NULL""",
    "priority_options": """
        SELECT DISTINCT priority FROM shop_support_tickets WHERE priority IS NOT NULL""",
    "lenient_datetimes": """
        SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS read_time,
               NULL::TIMESTAMP AS absent_time
        FROM events""",
    "formatted_customers": f"""
        SELECT customer_id, {count_text('count(*) * 1000')} AS orders,
               {money_text(total('total_amount'))} AS spent,
               strftime(max(order_date), {MINUTE}) AS last_order
        FROM shop_orders GROUP BY customer_id""",
    "report_over_90_days": f"""
        SELECT order_date::DATE AS order_day, {total('total_amount')} AS revenue
        FROM ({recent('shop_orders', 'order_date', 90)})
        WHERE status IS NOT NULL GROUP BY 1""",
    "report_rows": REPORT_ROWS,
    "web_decode": "SELECT * FROM shop_web_events",
    "cdc_drops_deletes": f"""
        SELECT {CHANGE_OP} AS op, * FROM shop_orders WHERE status <> 'P'""",
    "cdc_rejects": f"""
        SELECT 'shop.public.orders' AS topic, 'd' AS op, message, count(*) AS rows
        FROM ({ORDER_MESSAGE}) WHERE message LIKE '%"after":null%' GROUP BY message""",
    "cdc_unreadable_messages": """
        SELECT 0::BIGINT AS changes, count(*) AS clicks, 0::BIGINT AS clicks_with_id
        FROM events""",
    "cdc_encode_orders": ORDER_MESSAGE,
    "event_messages": f"""
        SELECT json_object('event_id', event_id, 'session_id', session_id,
                           'customer_id', customer_id, 'event_type', event_type,
                           'event_timestamp', {ISO.replace('(ts', '(event_timestamp')})::VARCHAR
                   AS message
        FROM shop_web_events""",
    "epoch_conversions": """
        SELECT event_id, epoch_us(ts) // 1000 AS millis, (ts::DATE - DATE '1970-01-01')::BIGINT AS days,
               date_trunc('millisecond', ts) AS exact_time,
               date_trunc('second', ts) AS second_time,
               ts::DATE AS day, NULL::DATE AS no_day
        FROM events""",
    "iso_conversions": f"""
        SELECT event_id, {ISO} AS text, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS text_seconds,
               ts AS read_time, date_trunc('second', ts) - INTERVAL 2 HOUR AS offset_time,
               NULL::TIMESTAMP AS no_time
        FROM events""",
    "partition_columns": """
        SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
               strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
        FROM events""",
    "enriched_payments": """
        SELECT created_at AS kafka_timestamp, 'c' AS op, *,
               TIMESTAMP '2024-02-03 04:05:06' AS _ingested_at,
               '2024' AS year, '02' AS month, '03' AS day, '04' AS hour
        FROM shop_payments""",
    "topic_routing": " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, count(*) AS messages FROM shop_{n}" for n in SHOP_SQL
    ),
    "audit_unknown_topics": STRAY,
    "audit_stream": STRAY,
    "lake_merged_columns": """
        SELECT c_custkey AS contact_id, c_name AS name, c_mktsegment AS segment,
               NULL::DOUBLE AS balance FROM customer
        UNION ALL
        SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
    "lake_files_with_new_columns": """
        SELECT order_id, customer_id, order_date, total_amount, status,
               CASE WHEN status <> 'F' THEN shipping_address END AS shipping_address
        FROM shop_orders""",
    "landed_batch_orders": "SELECT 'r' AS op, * FROM shop_orders",
    "fetched_customers": "SELECT * FROM shop_customers",
    "tables_with_rows": " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, EXISTS (SELECT 1 FROM shop_{n}) AS has_rows" for n in SHOP_SQL
    )
    + " UNION ALL SELECT 'no_orders', EXISTS (SELECT 1 FROM shop_orders WHERE total_amount < 0)",
    "backfill_then_stream": count_by("shop_orders", "status", "orders"),
    "followed_orders": count_by("(SELECT * FROM shop_orders WHERE status <> 'F')", "status", "orders"),
    "log_between_offsets": """
        SELECT o_orderkey::VARCHAR AS order_id, o_orderstatus AS status FROM (
            SELECT *, row_number() OVER (PARTITION BY o_orderkey % 3 ORDER BY o_orderkey) - 1 AS place,
                   count(*) OVER (PARTITION BY o_orderkey % 3) AS n
            FROM orders)
        WHERE place >= n // 4 AND place < 3 * n // 4""",
    "log_missing_offsets": """
        SELECT 'shop.public.orders' AS topic, p::INTEGER AS partition, min(place) AS start, max(place) + 1 AS "end"
        FROM (SELECT p, place, place - row_number() OVER (PARTITION BY p ORDER BY place) AS run
              FROM (SELECT o_orderkey % 3 AS p, o_orderstatus,
                           row_number() OVER (PARTITION BY o_orderkey % 3 ORDER BY o_orderkey) - 1 AS place
                    FROM orders)
              WHERE o_orderstatus = 'P')
        GROUP BY p, run""",
    "ledger_resumed_orders": count_by("shop_orders", "status", "orders"),
    "all_datasets_landed": " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, count(*) AS rows, TRUE AS has_data FROM shop_{n}"
        for n in SHOP_SQL
    ),
    "line_totals": """
        SELECT order_item_id, product_id, quantity, round(quantity * unit_price, 2) AS line_total
        FROM shop_order_items""",
    "order_rollup": f"""
        SELECT order_id, count(*) AS lines,
               {total('round(quantity * unit_price, 2)')} AS items_total
        FROM shop_order_items GROUP BY order_id""",
    "total_reconciliation": f"""
        SELECT order_id, total_amount, items_total
        FROM shop_orders LEFT JOIN (
            SELECT order_id, {total('round(quantity * unit_price, 2)')} AS items_total
            FROM shop_order_items GROUP BY order_id) USING (order_id)
        WHERE total_amount::DECIMAL(18,2) IS DISTINCT FROM items_total::DECIMAL(18,2)""",
    "payment_reconciliation": """
        SELECT payment_id, order_id, amount, total_amount
        FROM shop_payments LEFT JOIN shop_orders USING (order_id)
        WHERE amount::DECIMAL(18,2) IS DISTINCT FROM total_amount::DECIMAL(18,2)""",
    "orders_with_customer": """
        SELECT order_id, o.customer_id, order_date, total_amount, status,
               c.address AS shipping_address
        FROM shop_orders o JOIN shop_customers c ON o.customer_id = c.customer_id""",
    "payment_lag": """
        SELECT payment_id, order_id,
               trunc(epoch(created_at - order_date) / 60)::BIGINT AS lag_minutes
        FROM shop_payments JOIN shop_orders USING (order_id)
        WHERE created_at BETWEEN order_date AND order_date + INTERVAL 60 MINUTE""",
    "bucketed_reconciliation": f"""
        SELECT 'order total' AS "check", order_id AS key, total_amount, items_total AS other
        FROM shop_orders LEFT JOIN (
            SELECT order_id, {total('round(quantity * unit_price, 2)')} AS items_total
            FROM shop_order_items GROUP BY order_id) USING (order_id)
        WHERE total_amount::DECIMAL(18,2) IS DISTINCT FROM items_total::DECIMAL(18,2)
        UNION ALL
        SELECT 'payment', payment_id, total_amount, amount
        FROM shop_payments LEFT JOIN shop_orders USING (order_id)
        WHERE amount::DECIMAL(18,2) IS DISTINCT FROM total_amount::DECIMAL(18,2)
        UNION ALL
        SELECT 'lag', payment_id, NULL, trunc(epoch(created_at - order_date) / 60)
        FROM shop_payments JOIN shop_orders USING (order_id)
        WHERE created_at BETWEEN order_date AND order_date + INTERVAL 60 MINUTE""",
    "payment_lag_streamed": """
        SELECT payment_id, order_id,
               trunc(epoch(created_at - order_date) / 60)::BIGINT AS lag_minutes
        FROM shop_payments JOIN shop_orders USING (order_id)
        WHERE created_at BETWEEN order_date AND order_date + INTERVAL 60 MINUTE""",
    "ticket_resolution_minutes": """
        SELECT ticket_id, trunc(epoch(resolved_at - created_at) / 60)::BIGINT AS minutes,
               resolution_time_minutes
        FROM shop_support_tickets""",
    "shipping_minutes": """
        SELECT trunc(epoch(l_shipdate - o_orderdate) / 60)::BIGINT AS minutes,
               count(*) AS lines
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "previous_step": """
        SELECT event_id, session_id, 'https://example.com/' || event_type AS page_url,
               lag('https://example.com/' || event_type, 1, 'https://example.com') OVER (
                   PARTITION BY session_id ORDER BY event_timestamp, event_id) AS referrer_url
        FROM shop_web_events""",
    "previous_step_by_user": """
        SELECT event_id, lag(event_type) OVER (
                   PARTITION BY customer_id ORDER BY event_timestamp, event_id) AS before
        FROM shop_web_events""",
    "month_tags": """
        SELECT spend_id, '_' || strftime(spend_date, '%Y%m') AS month_tag,
               spend_date::TIMESTAMP AS day_start
        FROM shop_marketing_spend""",
    "pk_violations": """
        SELECT order_item_id, count(*) AS rows FROM shop_order_items
        GROUP BY order_item_id HAVING count(*) > 1""",
    "unique_email_violations": """
        SELECT email, count(*) AS rows FROM shop_customers GROUP BY email HAVING count(*) > 1""",
    "fk_orphans": ORPHANS,
    "null_violations": rule_rows(
        "shop_support_tickets", _null("ticket_id") | _null("order_id") | _null("resolved_at")
    ),
    "domain_violations": rule_rows(
        "(SELECT *, total_price * 1000 AS large FROM shop_order_items)",
        _size("order_item_id", 6) | _size("product_id", 36) | _money("total_price")
        | _money("large"),
    ),
    "source_rule_violations": " UNION ALL ".join(
        rule_rows(f"shop_{name}", rules, f", '{name}' AS dataset")
        for name, rules in TABLE_RULES.items()
    ),
    "insert_ignore": """
        SELECT * FROM lineitem l
        WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R'
                          AND r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber)
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "insert_ignore_stream": """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag FROM lineitem
        QUALIFY row_number() OVER (
            PARTITION BY l_orderkey
            ORDER BY CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END, l_shipdate, l_linenumber) = 1""",
    "seeded_if_empty": "SELECT customer_id, email FROM shop_customers",
}
for _name in SHOP_SQL:
    if _name != "web_events":
        BODIES[f"cdc_roundtrip_{_name}"] = f"SELECT * FROM shop_{_name}"
    BODIES[f"stream_{_name}_landed"] = f"SELECT * FROM shop_{_name}"

# Each step settles a round over all rows: out if a value is taken, else in if first under
# both keys of those still open.
BODIES["insert_ignore_two_keys"] = """
    WITH RECURSIVE lines AS (
        SELECT *, l_orderkey || '-' || l_linenumber AS line, l_partkey || '-' || l_suppkey AS supply
        FROM lineitem
    ),
    offered AS (
        SELECT row_number() OVER (ORDER BY l_shipdate, line, supply, l_extendedprice) AS n, line, supply
        FROM lines
        WHERE line NOT IN (SELECT line FROM lines WHERE l_returnflag = 'R')
          AND supply NOT IN (SELECT supply FROM lines WHERE l_returnflag = 'R')
    ),
    rounds AS (
        SELECT 0 AS round, n, line, supply, 'open' AS state FROM offered
        UNION ALL
        SELECT round + 1, n, line, supply,
               CASE WHEN state <> 'open' THEN state WHEN taken THEN 'out' WHEN first THEN 'in' ELSE 'open' END
        FROM (
            SELECT *, bool_or(state = 'in') OVER (PARTITION BY line)
                      OR bool_or(state = 'in') OVER (PARTITION BY supply) AS taken,
                   n = min(n) FILTER (WHERE state = 'open') OVER (PARTITION BY line)
                      AND n = min(n) FILTER (WHERE state = 'open') OVER (PARTITION BY supply) AS first,
                   bool_or(state = 'open') OVER () AS unsettled
            FROM rounds
        ) WHERE unsettled
    )
    SELECT line, supply FROM rounds WHERE state = 'in' AND round = (SELECT max(round) FROM rounds)"""

# Queries that no SQL states.
WITHOUT_SQL = ()

ORACLE_SQL = {name: shop_query(body) for name, body in BODIES.items()}
