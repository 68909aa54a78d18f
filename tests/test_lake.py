import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plans import scanned_rows
from tidemill import catalog, session
from tidemill.operators.enrich import add_ingestion_metadata
from tidemill.sources import footers, lake, logs, tables
from tidemill.streaming import sinks

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def write(spark, path, values, age, **columns):
    """One file with the given values of ``a``, so many hours old."""
    frame = spark.createDataFrame([(v,) for v in values], "a bigint").coalesce(1)
    for name, value in columns.items():
        frame = frame.withColumn(name, F.lit(value))
    frame.write.mode("overwrite").parquet(str(path))
    (file,) = path.glob("*.parquet")
    moment = dt.datetime(2024, 1, 1).timestamp() - age * 3600
    os.utime(file, (moment, moment))
    return file


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_newest_files_and_their_rows(spark, tmp_path):
    new = write(spark, tmp_path / "p=1" / "q=2", [1, 2], 0, b="new")
    old = write(spark, tmp_path / "p=1" / "q=1", [3], 5, b="old")
    oldest = write(spark, tmp_path / "p=0" / "q=9", [4], 9, b="oldest")
    (tmp_path / "p=1" / "note.txt").write_text("not data")
    root = str(tmp_path)

    names = [p.removeprefix("file:") for p in lake.newest_files(spark, root, 2)]
    assert [p.replace("///", "/") for p in names] == [str(new), str(old)]
    assert len(lake.newest_files(spark, root, 30)) == 3
    assert lake.list_files(spark, root).count() == 3 and oldest.exists()
    newest = lake.load_dataset(spark, root, SCHEMA, newest=2)
    assert rows(newest.select("a", "b")) == [
        (1, "new"), (2, "new"), (3, "old"),
    ]

    scan = lake.load_dataset(spark, root, SCHEMA, newest=2, located=True)
    assert [r.a for r in lake.preview(scan).collect()] == [1, 2, 3]
    assert [r.a for r in lake.preview(scan.where("a > 1"), 1).collect()] == [2]


def test_missing_and_empty_lakes(spark, tmp_path):
    missing = str(tmp_path / "none")
    assert lake.newest_files(spark, missing, 5) == []
    assert not lake.has_data(spark, missing)
    for newest in (None, 5):
        empty = lake.load_dataset(spark, missing, catalog.ORDERS, newest=newest)
        assert empty.schema == catalog.ORDERS.landed_schema() and empty.isEmpty()


def test_columns_of_all_files(spark, tmp_path):
    write(spark, tmp_path / "p=1", [1], 0, b="x")
    write(spark, tmp_path / "p=2", [2], 0)
    root = str(tmp_path)
    assert rows(lake.load_dataset(spark, root, SCHEMA).drop("p")) == [(1, "x"), (2, None)]
    assert rows(lake.load_dataset(spark, root).select("a", "b")) == [(1, "x"), (2, None)]


def test_existence_probe_ignores_the_sink_log(spark, tmp_path):
    (tmp_path / "_spark_metadata").mkdir()
    (tmp_path / "_spark_metadata" / "0").write_text("v1")
    assert not lake.has_data(spark, str(tmp_path))
    (tmp_path / "year=2024").mkdir()
    assert not lake.has_data(spark, str(tmp_path))
    (tmp_path / "year=2024" / "any.file").write_text("x")
    assert lake.has_data(spark, str(tmp_path))


def test_ingestion_hours_prune_folders(spark, tmp_path):
    root = str(tmp_path / "orders")
    for hour in (1, 2, 13):
        rows_of_hour = spark.createDataFrame([(f"o{hour}",)], "order_id string")
        now = F.lit(dt.datetime(2024, 1, 1, hour))
        sinks.land_batch(add_ingestion_metadata(rows_of_hour, now), root)
    since = dt.datetime(2024, 1, 1, 2, 30)
    recent = lake.load_dataset(spark, root, catalog.ORDERS, ingested_since=since)
    assert [(r.order_id, r.hour) for r in recent.orderBy("hour").collect()] == [
        ("o2", "02"), ("o13", "13"),
    ]
    unsorted = lake.load_dataset(spark, root, catalog.ORDERS, ingested_since=since)
    unsorted.collect()
    assert scanned_rows(unsorted) == [2]


def test_batch_refuses_the_folder_of_a_stream(spark, tmp_path):
    (tmp_path / "orders" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="belongs to a stream"):
        sinks.land_batch(add_ingestion_metadata(spark.range(1)), str(tmp_path / "orders"))


def test_tables(spark):
    customers = spark.range(2).select(
        F.col("id").alias("extra"), *[F.lit("x").alias(f.name) for f in catalog.CUSTOMERS.fields]
    )
    assert tables.fetch(customers, catalog.CUSTOMERS).columns == [
        "customer_id", "first_name", "last_name", "email", "phone", "address", "city", "country",
        "registration_date",
    ]
    assert tables.has_rows(customers) and not tables.has_rows(customers.limit(0))
    assert rows(tables.presence(customers.limit(0), "customers")) == [("customers", False)]


def test_jdbc_reads_are_split_by_key_without_loss(spark):
    keys = ["0a", "f1", "e9", "E9", "zz", "", "00", "ff", "7f3c", None]
    frame = spark.createDataFrame([(k,) for k in keys], "k string")
    for digits in (1, 2):
        ranges = tables.key_ranges("k", digits)
        assert len(ranges) == 16**digits
        counts = frame.agg(*[F.count_if(F.expr(p)).alias(f"n{i}") for i, p in enumerate(ranges)]).first()
        assert sum(counts) == len(keys)
        hits = frame.select(sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in ranges).alias("n"))
        assert {r.n for r in hits.collect()} == {1}


class Recorder:
    """Stands in for a session whose readers only note what they are asked for."""

    def __init__(self):
        self.asked = {}
        self.read = self.readStream = self

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked |= options
        return self

    def load(self):
        return self.asked

    def jdbc(self, url, table, predicates, properties):
        self.asked |= {"url": url, "table": table, "predicates": predicates, **properties}
        return self

    def select(self, *columns):
        return {**self.asked, "columns": list(columns)}


def test_kafka_readers_ask_for_the_right_topics():
    log = logs.KafkaLog("broker:9092", {"minPartitions": "64"})
    common = {
        "format": "kafka",
        "kafka.bootstrap.servers": "broker:9092",
        "failOnDataLoss": "true",
        "minPartitions": "64",
    }
    topic = catalog.ORDERS.topic("shop")
    assert log.read(Recorder(), topic) == {
        **common,
        "subscribe": "shop.public.orders",
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }
    assert log.stream(Recorder(), topic) == {
        **common, "subscribe": "shop.public.orders", "startingOffsets": "latest",
    }
    pattern = logs.table_topics("shop")
    assert log.stream_matching(Recorder(), pattern) == {
        **common, "subscribePattern": "shop\\.public\\..*", "startingOffsets": "latest",
    }
    assert catalog.WEB_EVENTS.topic("shop") == "web_events"
    assert sinks.kafka_sink_options("broker:9092", "web_events") == {
        "kafka.bootstrap.servers": "broker:9092", "topic": "web_events", "kafka.acks": "all",
    }


def test_topic_pattern_rules_known_tables_out(spark):
    topics = ["shop.public.orders", "shop.public.orders_old", "shop.public.x", "shopXpublic.x"]
    frame = spark.createDataFrame([(t,) for t in topics], "topic string")

    def matching(pattern):
        return [r.topic for r in frame.where(F.col("topic").rlike(f"^(?:{pattern})$")).collect()]

    assert matching(logs.table_topics("shop")) == topics[:3]
    assert matching(logs.table_topics("shop", ["orders", "customers"])) == topics[1:3]


def test_jdbc_asks_for_the_columns_of_the_dataset():
    asked = tables.jdbc_table(Recorder(), "jdbc:postgresql://db/shop", catalog.ORDERS, user="u")
    assert asked["table"] == "orders" and asked["user"] == "u"
    assert asked["columns"] == [f.name for f in catalog.ORDERS.fields]
    assert asked["predicates"] == tables.key_ranges("order_id")
    asked = tables.jdbc_table(Recorder(), "jdbc:postgresql://db/shop", catalog.ORDERS, digits=2)
    assert len(asked["predicates"]) == 256


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    paths = {session.scratch_path(spark, "lake") for _ in range(2)}
    assert len(paths) == 2 and all(p.startswith(f"{shared}/lake-") for p in paths)


def test_row_counts_come_from_footers(spark, tmp_path):
    """Files with other columns, or columns in another order, count alike; nothing is read."""
    root, hours = str(tmp_path / "lake"), catalog.PARTITION_COLUMNS
    place = lambda hour: [F.lit(v).alias(c) for c, v in zip(hours, ("2024", "01", "02", hour))]
    assert footers.row_count(spark, root) == 0 and footers.rows_by_hour(spark, root).count() == 0
    numbers = spark.range(10, numPartitions=3)
    sinks.land_batch(numbers.select("id", F.lit(0.5).alias("x"), *place("03")), root)
    sinks.land_batch(numbers.select(F.lit("y").alias("z"), (F.col("id") + 500).alias("id"), *place("03")), root)
    sinks.land_batch(numbers.where("id < 4").select("id", *place("23")), root)
    counts = footers.rows_by_hour(spark, root)
    assert rows(counts) == [("2024", "01", "02", "03", 20), ("2024", "01", "02", "23", 4)]
    assert footers.row_count(spark, root) == 24
    plan = footers.hourly_counts(footers.footer_session(spark), root)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<year:string,month:string,day:string,hour:string,count(*):bigint>" in plan
    # The caller's session keeps its own reader.
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
