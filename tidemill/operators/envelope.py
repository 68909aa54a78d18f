"""Log rows to dataset rows and back.

Log rows have the shape of a Kafka read: ``value`` (binary), ``timestamp`` and
``topic`` are used. Every function works on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.catalog import DatasetSpec
from tidemill.functions.temporal import to_epoch_days, to_epoch_millis, to_iso


def parse_messages(log: DataFrame, spec: DatasetSpec, *carried: str | Column) -> DataFrame:
    """One row per log row: the carried columns, then the top-level message fields.

    A message that is no such JSON object gives NULL fields. ``inline`` keeps a
    later filter on the parsed fields from being pushed below the parser, which
    would parse every message twice.
    """
    message = F.from_json(F.col("value").cast("string"), spec.message_schema())
    return log.select(*carried, F.inline(F.array(message)))


def _flatten(parsed: DataFrame, spec: DatasetSpec, *carried: str) -> DataFrame:
    prefix = "after." if spec.change_events else ""
    head = [*carried, "op"] if spec.change_events else list(carried)
    return parsed.select(
        *head, *[F.col(prefix + f.name).alias(f.staged_name) for f in spec.fields]
    )


def decode(log: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Log rows of one topic as dataset rows, epoch columns still in their wire form.

    Change events without a key are dropped: deletes, tombstones and messages
    that do not parse. Clicks are all kept, an unreadable one as a row of NULLs.
    """
    parsed = parse_messages(log, spec, F.col("timestamp").alias("kafka_timestamp"))
    rows = _flatten(parsed, spec, "kafka_timestamp")
    return rows.where(F.col(spec.key).isNotNull()) if spec.change_events else rows


def rejected(log: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The log rows ``decode`` drops, with their text: its key filter, negated."""
    carried = [
        "topic",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("message"),
    ]
    parsed = parse_messages(log, spec, *carried)
    return parsed.where(F.col(f"after.{spec.key}").isNull()).select(
        "topic", "kafka_timestamp", "op", "message"
    )


def peek(log: DataFrame) -> DataFrame:
    """Any change event without knowing its table: topic, time, op and the raw new row."""
    text = F.col("value").cast("string")
    return log.select(
        "topic",
        F.col("timestamp").alias("kafka_timestamp"),
        F.get_json_object(text, "$.op").alias("op"),
        F.get_json_object(text, "$.after").alias("after_json"),
    )


def without_topics(log: DataFrame, topics: list[str]) -> DataFrame:
    """Rows of topics not in the list."""
    return log.where(~F.col("topic").isin(*topics)) if topics else log


def _to_wire(column: Column, kind: str) -> Column:
    if kind == "epoch_ms":
        return to_epoch_millis(column)
    if kind == "epoch_days":
        return to_epoch_days(column)
    if kind == "iso_ts":
        return to_iso(column)
    return column


def encode(
    rows: DataFrame,
    spec: DatasetSpec,
    topic_prefix: str = "shop",
    op: str | Column = "r",
    timestamp: Column | None = None,
) -> DataFrame:
    """Dataset rows as log rows, the inverse of ``decode``; NULL fields are written out.

    ``op`` is a constant or a column; a delete carries no new row.
    """
    row = F.struct(*[_to_wire(F.col(f.name), f.kind).alias(f.name) for f in spec.fields])
    if spec.change_events:
        op = F.lit(op) if isinstance(op, str) else op
        row = F.struct(op.alias("op"), F.when(op != "d", row).alias("after"))
    key = F.to_json(F.struct(F.col(spec.key)))
    return rows.select(
        key.cast("binary").alias("key"),
        F.to_json(row, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        F.lit(spec.topic(topic_prefix)).alias("topic"),
        (F.current_timestamp() if timestamp is None else timestamp).alias("timestamp"),
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Rows of any shape as JSON messages: timestamps in ISO form, NULLs kept, no key."""
    fields = [
        to_iso(F.col(name)).alias(name) if kind.startswith("timestamp") else F.col(name)
        for name, kind in events.dtypes
    ]
    message = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return events.select(message.cast("binary").alias("value"))
