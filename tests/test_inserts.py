import pytest
from pyspark.sql import functions as F

from tidemill.operators.insert import insert_ignore
from tidemill.sources import lake
from tidemill.streaming import sinks
from tidemill.streaming.inserts import InsertTable

SCHEMA = "id long, name string, n int"


@pytest.fixture
def table(spark, tmp_path):
    return InsertTable(f"{tmp_path}/t", spark.createDataFrame([], SCHEMA).schema, ["id"], ["n"])


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def held(spark, table):
    return sorted(map(tuple, table.rows(spark).collect()))


def test_first_rows_stay_and_a_batch_goes_in_once(spark, table):
    assert held(spark, table) == []
    assert table.insert(batch(spark, (1, "a", 2), (1, "b", 1), (None, "c", 1), (2, "d", 1)), 0)
    assert table.insert(batch(spark, (2, "e", 0), (3, "f", 5)), 1)
    assert held(spark, table) == [(1, "b", 1), (2, "d", 1), (3, "f", 5)]
    assert not table.insert(batch(spark, (9, "x", 1)), 1)
    assert table.insert(batch(spark, (1, "y", 1)), 1, "another writer")
    assert table.insert(batch(spark), 2)
    assert held(spark, table) == [(1, "b", 1), (2, "d", 1), (3, "f", 5)]


def test_what_a_failed_attempt_left_is_not_read(spark, table, monkeypatch):
    table.insert(batch(spark, (1, "a", 1)), 0)
    batch(spark, (5, "half", 1), (6, "half", 1)).write.parquet(table.folder("batch", 1))
    assert held(spark, table) == [(1, "a", 1)]
    table.insert(batch(spark, (1, "z", 1), (6, "whole", 1)), 1)
    assert held(spark, table) == [(1, "a", 1), (6, "whole", 1)]


def test_only_folders_that_may_hold_a_key_are_opened(spark, table):
    for number in range(6):
        rows = spark.range(100 * number, 100 * number + 100).select("id", F.lit("x").alias("name"), F.lit(number).alias("n"))
        table.insert(rows, number)
    near = table.holding(batch(spark, (250, "q", 0), (310, "q", 0)))
    folders = {path.rsplit("/", 2)[1] for path in near.inputFiles()}
    assert folders == {"batch-2", "batch-3"} and near.count() == 61
    assert "GreaterThanOrEqual(id,250)" in near._jdf.queryExecution().executedPlan().toString()
    assert table.holding(batch(spark, (900, "q", 0))).inputFiles() == []
    assert table.holding(batch(spark)).count() == 0


def test_a_replayed_stream_adds_nothing(spark, table, tmp_path):
    source = f"{tmp_path}/source"

    def land(checkpoint):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        table.insert_stream(stream, f"{tmp_path}/{checkpoint}", trigger=sinks.ONCE).awaitTermination()

    batch(spark, (1, "a", 1), (2, "a", 1)).coalesce(1).write.mode("append").parquet(source)
    land("c")
    batch(spark, (2, "b", 0), (3, "b", 0)).coalesce(1).write.mode("append").parquet(source)
    land("c")
    expected = [(1, "a", 1), (2, "a", 1), (3, "b", 0)]
    assert held(spark, table) == expected
    files = lake.list_files(spark, f"{table.path}/rows").count()
    land("new")
    assert held(spark, table) == expected and lake.list_files(spark, f"{table.path}/rows").count() == files


def test_many_batches_equal_one_insert_after_the_other(spark, tmp_path):
    rows = spark.range(600).select((F.xxhash64("id") % 90).alias("id"), F.lit("r").alias("name"), (F.col("id") % 17).cast("int").alias("n"), (F.col("id") % 4).alias("turn"))
    key = ["id", "name"]
    table = InsertTable(f"{tmp_path}/t", rows.drop("turn").schema, key, ["n"])
    expected = rows.drop("turn").limit(0)
    for turn in range(4):
        part = rows.where(f"turn = {turn}").drop("turn")
        expected = spark.createDataFrame(expected.unionByName(insert_ignore(expected, part, key, ["n"])).collect(), part.schema)
        table.insert(part, turn)
    assert held(spark, table) == sorted(map(tuple, expected.collect()))
