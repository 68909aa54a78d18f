"""From a log to the lake, for one dataset or all of them.

Backfill and live rows go through one checkpointed query per dataset, so
nothing between them is lost or landed twice, and a restart adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemill.catalog import CHANGE_DATASETS, DATASETS, DatasetSpec
from tidemill.operators.enrich import enrich
from tidemill.operators.envelope import decode, peek, without_topics
from tidemill.sources.lake import exists, has_data
from tidemill.sources.logs import (
    AUDIT_OFFSETS,
    BACKFILL_OFFSETS,
    FOLLOW_OFFSETS,
    FileLog,
    KafkaLog,
    table_topics,
)
from tidemill.streaming.sinks import ONCE, land_stream, print_stream

Log = KafkaLog | FileLog


def lake_rows(
    spark: SparkSession, spec: DatasetSpec, log: Log, topic_prefix: str, starting: str
) -> DataFrame:
    """The stream of one dataset as it lands."""
    messages = log.stream(spark, spec.topic(topic_prefix), starting)
    return messages.transform(decode, spec).transform(enrich, spec)


def starting_offsets(spark: SparkSession, spec: DatasetSpec, lake: str) -> str:
    """Where a first start begins: at the start of the log while the lake has nothing.

    Only datasets that are backfilled begin there; the others follow what comes.
    """
    if spec.backfilled and not has_data(spark, spec.lake_path(lake)):
        return BACKFILL_OFFSETS
    return FOLLOW_OFFSETS


def land_dataset(
    spark: SparkSession,
    spec: DatasetSpec,
    log: Log,
    lake: str,
    checkpoints: str,
    topic_prefix: str = "shop",
    trigger: dict | None = None,
    hook: Callable[[DataFrame], DataFrame] | None = None,
    starting: str | None = None,
) -> StreamingQuery:
    """Start landing one dataset: history first where the lake has none, then what follows.

    ``hook`` may change the rows before they are written. ``starting`` says where a first
    start begins (by default ``starting_offsets``); a query with a checkpoint goes on from
    there, and skips nothing.
    """
    if exists(spark, f"{spec.checkpoint_path(checkpoints)}/offsets"):
        starting = BACKFILL_OFFSETS
    starting = starting or starting_offsets(spark, spec, lake)
    rows = lake_rows(spark, spec, log, topic_prefix, starting)
    if hook is not None:
        rows = rows.transform(hook)
    return land_stream(
        rows, spec.lake_path(lake), spec.checkpoint_path(checkpoints), trigger, spec.name
    )


def backfill(
    spark: SparkSession,
    spec: DatasetSpec,
    log: Log,
    lake: str,
    checkpoints: str,
    topic_prefix: str = "shop",
) -> None:
    """Land everything the log holds now, then return; a later start follows on."""
    query = land_dataset(
        spark, spec, log, lake, checkpoints, topic_prefix, ONCE, starting=BACKFILL_OFFSETS
    )
    query.awaitTermination()


def unregistered_changes(
    spark: SparkSession,
    log: Log,
    topic_prefix: str = "shop",
    known: Iterable[DatasetSpec] = CHANGE_DATASETS,
    starting: str = AUDIT_OFFSETS,
) -> DataFrame:
    """Stream of changes to tables no dataset is registered for."""
    specs = list(known)
    pattern = table_topics(topic_prefix, but_not=[s.name for s in specs])
    others = peek(log.stream_matching(spark, pattern, starting))
    return without_topics(others, [s.topic(topic_prefix) for s in specs])


def run_all(
    spark: SparkSession,
    log: Log,
    lake: str,
    checkpoints: str,
    topic_prefix: str = "shop",
    specs: Iterable[DatasetSpec] = DATASETS,
    trigger: dict | None = None,
    audit: bool = True,
    starting: str | None = None,
) -> None:
    """Land every dataset and print changes to other tables, until one query ends.

    With the ``availableNow`` trigger all queries run to their end instead. A first start
    follows each dataset's rule, and the audit what comes, unless ``starting`` says where.
    """
    specs = list(specs)
    queries: list[StreamingQuery] = []
    bounded = bool(trigger and trigger.get("availableNow"))
    # Queries that ended before, a backfill for one, are not what is waited for.
    spark.streams.resetTerminated()
    try:
        for spec in specs:
            queries.append(
                land_dataset(
                    spark, spec, log, lake, checkpoints, topic_prefix, trigger, starting=starting
                )
            )
        if audit:
            known = [spec for spec in specs if spec.change_events]
            checkpoint = f"{checkpoints.rstrip('/')}/unregistered"
            first = starting or AUDIT_OFFSETS
            if exists(spark, f"{checkpoint}/offsets"):
                first = BACKFILL_OFFSETS
            others = unregistered_changes(spark, log, topic_prefix, known, first)
            queries.append(print_stream(others, trigger=trigger, checkpoint=checkpoint))
        if bounded:
            for query in queries:
                query.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
