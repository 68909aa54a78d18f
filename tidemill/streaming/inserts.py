"""Insert-ignore as a sink: a table that takes each batch of a stream once, and each key once.

Every batch has a folder of its own, and an entry in the table's ledger once the folder is
complete. Readers see the folders that the ledger names, so what a failed attempt left
is never read, and is overwritten when the batch is tried again. An entry also holds the
range of the batch's first key: a new batch opens only the folders that may hold a key of its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.insert import insert_ignore
from tidemill.sources.lake import exists


@dataclass(frozen=True)
class InsertTable:
    """A folder of rows with unique keys.

    ``key`` names one column or several; ``order_by`` says which row of a batch is the first
    of its key. Rows of earlier batches stay. One writer at a time.
    """

    path: str
    schema: T.StructType
    key: list[str]
    order_by: list[str | Column] = field(default_factory=list)

    @property
    def ledger(self) -> str:
        return f"{self.path.rstrip('/')}/ledger"

    def folder(self, writer: str, batch: int) -> str:
        return f"{self.path.rstrip('/')}/rows/{writer}-{batch}"

    def entries(self, spark: SparkSession) -> DataFrame:
        """(writer, batch, rows, least, most) of every batch that is in the table."""
        kind = self.schema[self.key[0]].dataType
        columns = T.StructType(
            [
                T.StructField("writer", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("rows", T.LongType()),
                T.StructField("least", kind), T.StructField("most", kind),
            ]
        )
        if not exists(spark, self.ledger):
            return spark.createDataFrame([], columns)
        return spark.read.schema(columns).parquet(self.ledger)

    def _read(self, spark: SparkSession, entries: DataFrame) -> DataFrame:
        # One short row a batch.
        folders = [self.folder(row.writer, row.batch) for row in entries.where("rows > 0").select("writer", "batch").collect()]
        return spark.read.schema(self.schema).parquet(*folders) if folders else spark.createDataFrame([], self.schema)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The table as it is now: what a batch adds later is not in it."""
        return self._read(spark, self.entries(spark))

    def holding(self, keys: DataFrame) -> DataFrame:
        """Rows of the folders that may hold a first key in the range of ``keys``."""
        spark, first = keys.sparkSession, self.key[0]
        least, most = keys.agg(F.min(first), F.max(first)).first()
        if least is None:
            return spark.createDataFrame([], self.schema)
        near = self.entries(spark).where((F.col("most") >= F.lit(least)) & (F.col("least") <= F.lit(most)))
        return self._read(spark, near).where(F.col(first).between(F.lit(least), F.lit(most)))

    def insert(self, batch: DataFrame, number: int, writer: str = "batch") -> bool:
        """Add the rows of a batch whose keys are new; whether the batch itself was new.

        A NULL key is refused. A batch that the ledger has is not looked at again.
        """
        spark, first = batch.sparkSession, self.key[0]
        if not self.entries(spark).where((F.col("writer") == writer) & (F.col("batch") == number)).isEmpty():
            return False
        names = self.schema.fieldNames()
        fresh = insert_ignore(self.holding(batch), batch.select(*names), self.key, self.order_by or names)
        folder = self.folder(writer, number)
        fresh.write.mode("overwrite").parquet(folder)
        written = spark.read.schema(self.schema).parquet(folder)
        entry = written.agg(F.count("*").alias("rows"), F.min(first).alias("least"), F.max(first).alias("most"))
        named = entry.select(F.lit(writer).alias("writer"), F.lit(number).cast("long").alias("batch"), "rows", "least", "most")
        named.coalesce(1).write.mode("append").parquet(self.ledger)
        return True

    def insert_stream(
        self, rows: DataFrame, checkpoint: str, writer: str = "stream", trigger: dict | None = None
    ) -> StreamingQuery:
        """Insert each micro-batch of a stream. A batch that is run again adds nothing."""

        def add(batch: DataFrame, number: int) -> None:
            batch.persist()
            try:
                self.insert(batch, number, writer)
            finally:
                batch.unpersist()

        query = rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
        return (query.trigger(**trigger) if trigger else query).start()
