"""Reading the lake: whole datasets, the newest files, and whether there is anything."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from itertools import chain, islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.catalog import PARTITION_COLUMNS, DatasetSpec

# How many of the newest files a report over recent data reads.
NEWEST_FILES = {
    "web_events": 150,
    "orders": 80,
    "payments": 80,
    "customers": 20,
    "products": 20,
    "support_tickets": 40,
    "incidents": 20,
    "marketing_spend": 20,
}
NEWEST_FILES_DEFAULT = 30

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint"


def _hadoop_path(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _hadoop_path(spark, path)
    return files.exists(location)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, location = _hadoop_path(spark, path)
    return files.exists(location) and files.getFileStatus(location).isDirectory()


def has_data(spark: SparkSession, root: str) -> bool:
    """Whether any file lies below the folder, the sink's own log aside.

    The listing is read up to the first such file.
    """
    files, location = _hadoop_path(spark, root)
    if not files.exists(location):
        return False
    log = files.makeQualified(location).toString().rstrip("/") + "/_spark_metadata/"
    found = files.listFiles(location, True)
    while found.hasNext():
        if not found.next().getPath().toString().startswith(log):
            return True
    return False


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Parquet files below the folder with time and size; Spark lists them in parallel.

    Contents are not read. Below a streaming sink these are the committed files.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(root)
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_SCHEMA)
    return files.select("path", "modificationTime", "length")


def _walk(files, folder) -> Iterator[str]:
    """Parquet files below a folder, the greatest folder name first and in it the newest
    file; one folder's listing at a time is held."""
    entries = list(files.listStatus(folder))
    names = {e.getPath().toString(): e for e in entries if not e.getPath().getName().startswith(("_", "."))}
    for path in sorted((p for p, e in names.items() if e.isDirectory()), reverse=True):
        yield from _walk(files, names[path].getPath())
    plain = [(p, e) for p, e in names.items() if not e.isDirectory() and p.endswith(".parquet")]
    for path, _ in sorted(plain, key=lambda f: (-f[1].getModificationTime(), f[0])):
        yield path


def files_newest_first(spark: SparkSession, root: str) -> Iterator[list[str]]:
    """Paths of the Parquet files of a lake in growing groups, newest first.

    In a stream's folder only committed files count; Spark takes them from the sink's log,
    which it reads for any query of such a folder. Elsewhere folders are walked from the
    greatest name down, which is the newest ingestion hour, and files within one by time;
    what lies before the last group taken is all that is listed.
    """
    if not exists(spark, root):
        return
    size = 4
    if exists(spark, f"{root.rstrip('/')}/_spark_metadata"):
        known, done = list_files(spark, root), 0
        while True:
            newest = known.orderBy(F.desc("modificationTime"), "path").limit(done + size)
            paths = [row.path for row in newest.select("path").collect()][done:]
            if not paths:
                return
            yield paths
            done, size = done + len(paths), size * 4
    files, location = _hadoop_path(spark, root)
    if files.getFileStatus(location).isFile():
        yield [root]
        return
    walk = _walk(files, location)
    while paths := list(islice(walk, size)):
        yield paths
        size *= 4


def newest_files(spark: SparkSession, root: str, count: int) -> list[str]:
    """Paths of the ``count`` newest Parquet files, newest first."""
    return list(islice(chain.from_iterable(files_newest_first(spark, root)), count))


# Where a row lies: time and path of its file, place in the file.
FILE_POSITION = ("_file_time", "_file_path", "_file_row")
_POSITION_SOURCES = ("file_modification_time", "file_path", "row_index")
_POSITION_TYPES = ("timestamp", "string", "bigint")


def load_dataset(
    spark: SparkSession,
    root: str,
    schema: T.StructType | DatasetSpec | None = None,
    newest: int | None = None,
    ingested_since: dt.datetime | None = None,
    located: bool = False,
) -> DataFrame:
    """A landed dataset, or an empty frame of its schema while there is none.

    With a schema no footer is opened to plan the read, and columns older files
    lack are NULL; without one the schemas of all files are merged. ``newest``
    reads only that many of the newest files. ``ingested_since`` (UTC) skips the
    hour folders before it. ``located`` adds where each row lies, for ``preview``.
    """
    paths = [root] if newest is None else newest_files(spark, root, newest)
    frame = load_files(spark, root, schema, paths if exists(spark, root) else [], located)
    if ingested_since is not None and paths:
        hour = F.concat(*[F.col(c) for c in PARTITION_COLUMNS])
        frame = frame.where(hour >= ingested_since.strftime("%Y%m%d%H"))
    return frame


def load_files(
    spark: SparkSession,
    root: str,
    schema: T.StructType | DatasetSpec | None,
    paths: list[str],
    located: bool = False,
) -> DataFrame:
    """The given files of a dataset; no paths, no rows."""
    if isinstance(schema, DatasetSpec):
        schema = schema.landed_schema()
    if not paths:
        empty = spark.createDataFrame([], schema or T.StructType([]))
        nowhere = [F.lit(None).cast(t).alias(c) for c, t in zip(FILE_POSITION, _POSITION_TYPES)]
        return empty.select("*", *nowhere) if located else empty
    reader = spark.read
    reader = reader.option("mergeSchema", "true") if schema is None else reader.schema(schema)
    if is_folder(spark, root):
        reader = reader.option("basePath", root)
    frame = reader.parquet(*paths)
    if located:
        place = [F.col(f"_metadata.{s}").alias(c) for s, c in zip(_POSITION_SOURCES, FILE_POSITION)]
        frame = frame.select("*", *place)
    return frame


_SCHEME = "^[a-zA-Z0-9+.-]+:/+"


def first_rows(
    spark: SparkSession,
    root: str,
    schema: T.StructType | DatasetSpec,
    choose: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    rows: int = 20,
) -> DataFrame:
    """The first rows of a dataset that ``choose`` keeps, newest file first.

    Files are read in growing groups, the newest first, until enough rows pass; no file is
    left out while there are too few. ``choose`` must decide row by row.
    """
    taken = load_dataset(spark, root, schema, newest=0)
    taken, found = choose(taken), 0
    for paths in files_newest_first(spark, root):
        group = load_files(spark, root, schema, paths, located=True)
        # Of a group only what is still wanted reaches the driver, at most ``rows``.
        # Listings and readers write the scheme's slashes differently.
        names = F.array(*[F.lit(re.sub(_SCHEME, "/", path)) for path in paths])
        order = F.array_position(names, F.regexp_replace("_file_path", _SCHEME, "/"))
        more = choose(group).orderBy(order, "_file_row").limit(rows - found).drop(*FILE_POSITION).collect()
        taken = taken.unionAll(spark.createDataFrame(more, taken.schema)) if more else taken
        found += len(more)
        if found >= rows:
            break
    return taken


def preview(frame: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows of a located frame, filtered or not, newest file first."""
    time, path, row = FILE_POSITION
    return frame.orderBy(F.desc(time), path, row).limit(rows).drop(*FILE_POSITION)
