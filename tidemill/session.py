"""Session settings the operators are written for, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session.
RUNTIME_CONF = {
    # Epoch and ISO conversions, hour floors and partition folders all assume UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Splits the partition of a hot key in the fact-to-dimension joins.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keys are packed tightly in a shuffle: the default of 64 MB takes a task gigabytes.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
    # The default INT96 carries no statistics, so time filters could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # One ingestion hour means one or two open folders per task, a log's topics a few more: no
    # sort before writing.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Messages repeat their field names: half the bytes of the default, snappy.
    "spark.sql.parquet.compression.codec": "zstd",
    # Keep "01" a string when partition folders are read without a schema.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``RUNTIME_CONF`` to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str, master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above; ``master`` and ``conf`` are the caller's."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # Concurrent streams share the executors instead of queueing behind one another.
    settings = {"spark.scheduler.mode": "FAIR", **RUNTIME_CONF, **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    On a local master without the setting a temporary folder stands in for it;
    on a cluster a machine-local folder would lose data, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="tidemill-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable, without replacing a folder already set."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def stage(frame: DataFrame, label: str, *folders: str) -> DataFrame:
    """A frame written to the shared folder, by ``folders`` if given, and read back: what follows
    starts there."""
    path = scratch_path(frame.sparkSession, label)
    writer = frame.write.partitionBy(*folders) if folders else frame.write
    writer.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def unstage(frame: DataFrame) -> None:
    """Delete the files of a staged frame."""
    files = frame.inputFiles()
    if files:
        remove(frame.sparkSession, files[0].rpartition("/")[0])
