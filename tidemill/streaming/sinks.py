"""Where rows go: partitioned Parquet, the console, Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemill.catalog import PARTITION_COLUMNS
from tidemill.operators.envelope import event_messages
from tidemill.sources.lake import exists, has_data

ONCE = {"availableNow": True}


def land_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append a stream to a partitioned Parquet folder, exactly once.

    ``trigger`` is what ``writeStream.trigger`` takes; the default of a minute
    bounds the number of files, as does ``files_per_batch``, which joins input
    splits without a shuffle. A path takes one query with one checkpoint, and no
    files of a batch: readers trust the stream's file list and would lose sight of them.
    """
    spark, root = rows.sparkSession, path.rstrip("/")
    if not exists(spark, f"{root}/_spark_metadata") and has_data(spark, root):
        raise ValueError(f"{path} holds files that no stream wrote; land the stream elsewhere")
    if files_per_batch:
        rows = rows.coalesce(files_per_batch)
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITION_COLUMNS)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
    )
    if not name:
        return writer.start()
    # Under the FAIR scheduler each stream gets its share of the executors. The
    # query keeps the pool it was started in.
    context = rows.sparkSession.sparkContext
    pool = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", name)
    try:
        return writer.queryName(name).start()
    finally:
        context.setLocalProperty("spark.scheduler.pool", pool)


def land_batch(rows: DataFrame, path: str) -> None:
    """Append a batch to a partitioned Parquet folder.

    Refused where a stream lands: readers trust the stream's own file list and
    would never see the batch.
    """
    if exists(rows.sparkSession, f"{path.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{path} belongs to a stream; replay the rows through it instead")
    rows.write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(path)


def print_stream(
    rows: DataFrame, shown: int = 10, trigger: dict | None = None, checkpoint: str | None = None
) -> StreamingQuery:
    """Print the first rows of every micro-batch in full width.

    Unlike the built-in console sink, which fetches a whole micro-batch to print
    its head, this brings only the printed rows to the driver.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"Batch {batch_id}")
        batch.show(shown, truncate=False)

    writer = rows.writeStream.foreachBatch(show).outputMode("append")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}


def send_events(events: DataFrame, servers: str, topic: str) -> None:
    """Write rows to a topic as JSON messages, acknowledged by all replicas."""
    options = kafka_sink_options(servers, topic)
    event_messages(events).write.format("kafka").options(**options).save()


def send_event_stream(
    events: DataFrame, servers: str, topic: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """``send_events`` for a stream."""
    writer = (
        event_messages(events)
        .writeStream.format("kafka")
        .options(**kafka_sink_options(servers, topic))
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
