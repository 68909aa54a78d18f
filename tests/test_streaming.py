import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemill import catalog
from tidemill.operators import envelope
from tidemill.sources import lake
from tidemill.sources.logs import FileLog
from tidemill.streaming import landing, sinks

NOW = dt.datetime(2024, 1, 2, 3, 4, 5)


def orders(spark, first, last):
    return spark.range(first, last).select(
        F.col("id").cast("string").alias("order_id"),
        F.lit("c1").alias("customer_id"),
        F.lit(NOW).alias("order_date"),
        F.col("id").cast("double").alias("total_amount"),
        F.lit("shipped").alias("status"),
        F.lit(None).cast("string").alias("shipping_address"),
    )


def clicks(spark, count):
    return spark.range(count).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit("s").alias("session_id"),
        F.lit("c").alias("customer_id"),
        F.lit("purchase").alias("event_type"),
        F.lit(NOW).alias("event_timestamp"),
    )


def order_messages(spark, first, last):
    return envelope.encode(orders(spark, first, last).coalesce(1), catalog.ORDERS)


@pytest.fixture
def places(tmp_path):
    return FileLog(f"{tmp_path}/log", 1), f"{tmp_path}/lake", f"{tmp_path}/checkpoints"


def landed(spark, root, spec=catalog.ORDERS):
    return lake.load_dataset(spark, spec.lake_path(root), spec)


def test_backfill_restart_and_new_rows(spark, places):
    log, root, checkpoints = places
    for start in (0, 100, 200):
        log.append(order_messages(spark, start, start + 100))
    assert landing.starting_offsets(spark, catalog.ORDERS, root) == "earliest"
    landing.backfill(spark, catalog.ORDERS, log, root, checkpoints)
    frame = landed(spark, root)
    assert frame.count() == 300
    # One micro-batch per file, each with an ingestion time of its own.
    assert frame.select("_ingested_at").distinct().count() == 3
    assert landing.starting_offsets(spark, catalog.ORDERS, root) == "latest"
    assert landing.starting_offsets(spark, catalog.WEB_EVENTS, root) == "latest"

    landing.backfill(spark, catalog.ORDERS, log, root, checkpoints)
    assert landed(spark, root).count() == 300

    log.append(order_messages(spark, 300, 350))
    landing.backfill(spark, catalog.ORDERS, log, root, checkpoints)
    frame = landed(spark, root)
    assert frame.count() == 350 and frame.select("order_id").distinct().count() == 350
    first = frame.where("order_id = '7'").first()
    assert (first.order_date, first.total_amount, first.op) == (NOW, 7.0, "r")
    assert (first.year, first.hour) == (
        first._ingested_at.strftime("%Y"), first._ingested_at.strftime("%H"),
    )


def test_newest_files_are_the_committed_ones(spark, places):
    log, root, checkpoints = places
    log.append(order_messages(spark, 0, 10))
    landing.backfill(spark, catalog.ORDERS, log, root, checkpoints)
    folder = catalog.ORDERS.lake_path(root)
    orders(spark, 0, 5).write.parquet(f"{folder}/year=2000/stray")
    assert len(lake.newest_files(spark, folder, 10)) == 1
    assert landed(spark, root).count() == 10


def test_bad_messages_do_not_stop_the_stream(spark, places):
    log, root, checkpoints = places
    bad = ['{"op":"c","after":{"order_id":"x","order_date":9000000000000000000}}', "junk", None]
    topic = catalog.ORDERS.topic("shop")
    rows = [(m and m.encode(), topic, NOW) for m in bad]
    log.append(spark.createDataFrame(rows, "value binary, topic string, timestamp timestamp"))
    landing.backfill(spark, catalog.ORDERS, log, root, checkpoints)
    assert [(r.order_id, r.order_date) for r in landed(spark, root).collect()] == [("x", None)]


def test_all_datasets_from_one_log(spark, places, capsys):
    log, root, checkpoints = places
    log.append(order_messages(spark, 0, 40))
    log.append(envelope.encode(clicks(spark, 25), catalog.WEB_EVENTS))
    stray = spark.createDataFrame(
        [(b'{"op":"c","after":{"sku":"R2D2"}}', "shop.public.returns", NOW)],
        "value binary, topic string, timestamp timestamp",
    )
    log.append(stray)
    landing.run_all(spark, log, root, checkpoints, trigger=sinks.ONCE, starting="earliest")
    counts = {s.name: landed(spark, root, s).count() for s in catalog.DATASETS}
    expected = dict.fromkeys(counts, 0) | {"orders": 40, "web_events": 25}
    assert counts == expected
    assert not spark.streams.active
    printed = capsys.readouterr().out
    assert "shop.public.returns" in printed and "R2D2" in printed
    assert "shop.public.orders" not in printed


def test_one_failing_query_stops_all(spark, places):
    log, root, checkpoints = places
    log.append(order_messages(spark, 0, 10))

    class Broken(FileLog):
        def stream(self, spark, topic, starting="latest"):
            messages = super().stream(spark, topic, starting)
            if topic == "web_events":
                return messages
            failing = F.raise_error(F.lit("broken")).cast("binary")
            return messages.withColumn("value", F.when(F.col("value").isNotNull(), failing))

    with pytest.raises(Exception, match="broken"):
        landing.run_all(
            spark,
            Broken(log.path),
            root,
            checkpoints,
            specs=[catalog.WEB_EVENTS, catalog.ORDERS],
            trigger={"processingTime": "100 milliseconds"},
        )
    assert not spark.streams.active


def test_landed_times_can_be_skipped_by(spark, places):
    """Landed files keep statistics of their times, which a recent window needs."""
    log, root, checkpoints = places
    log.append(order_messages(spark, 0, 10))
    landing.backfill(spark, catalog.ORDERS, log, root, checkpoints)
    (path,) = lake.newest_files(spark, catalog.ORDERS.lake_path(root), 5)
    footer = pq.ParquetFile(path.removeprefix("file:")).metadata
    names = [footer.row_group(0).column(i).path_in_schema for i in range(footer.num_columns)]
    times = footer.row_group(0).column(names.index("order_date"))
    assert times.physical_type == "INT64" and times.statistics.has_min_max


def test_stream_refuses_the_folder_of_a_batch(spark, places):
    log, root, checkpoints = places
    log.append(order_messages(spark, 0, 10))
    path = catalog.ORDERS.lake_path(root)
    hour = [F.lit("01").alias(c) for c in catalog.PARTITION_COLUMNS]
    sinks.land_batch(orders(spark, 0, 5).select("*", *hour), path)
    with pytest.raises(ValueError, match="no stream wrote"):
        landing.backfill(spark, catalog.ORDERS, log, root, checkpoints)
    assert spark.read.parquet(path).count() == 5


def test_backfill_of_clicks_starts_at_the_beginning(spark, places):
    log, root, checkpoints = places
    asked = []

    class Noting(FileLog):
        def stream(self, spark, topic, starting="latest"):
            asked.append(starting)
            return super().stream(spark, topic, starting)

    log.append(envelope.encode(clicks(spark, 25), catalog.WEB_EVENTS))
    landing.backfill(spark, catalog.WEB_EVENTS, Noting(log.path), root, checkpoints)
    assert asked == ["earliest"]
    assert landed(spark, root, catalog.WEB_EVENTS).count() == 25


def test_following_stream_lands_later_messages_only(spark, places):
    log, root, checkpoints = places

    def follow():
        landing.land_dataset(
            spark, catalog.WEB_EVENTS, log, root, checkpoints, trigger=sinks.ONCE
        ).awaitTermination()

    log.append(envelope.encode(clicks(spark, 25), catalog.WEB_EVENTS))
    follow()
    assert landed(spark, root, catalog.WEB_EVENTS).count() == 0
    log.append(envelope.encode(clicks(spark, 7), catalog.WEB_EVENTS))
    follow()
    log.append(envelope.encode(clicks(spark, 2), catalog.WEB_EVENTS))
    follow()
    assert landed(spark, root, catalog.WEB_EVENTS).count() == 9


def test_hook_runs_before_the_write(spark, places):
    log, root, checkpoints = places
    log.append(order_messages(spark, 0, 10))
    landing.land_dataset(
        spark,
        catalog.ORDERS,
        log,
        root,
        checkpoints,
        trigger=sinks.ONCE,
        hook=lambda rows: rows.where("total_amount >= 5"),
    ).awaitTermination()
    assert landed(spark, root).count() == 5


def test_files_per_batch(spark, places, tmp_path):
    log, root, checkpoints = places
    for start in range(0, 60, 10):
        log.append(order_messages(spark, start, start + 10))
    rows = landing.lake_rows(spark, catalog.ORDERS, FileLog(log.path), "shop", "earliest")
    query = sinks.land_stream(rows, f"{root}/o", f"{checkpoints}/o", sinks.ONCE, files_per_batch=2)
    query.awaitTermination()
    assert lake.list_files(spark, f"{root}/o").count() <= 2
    assert spark.read.parquet(f"{root}/o").count() == 60
