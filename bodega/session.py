"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Plan-independent settings. Sizes are per task, so they hold at any table size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # tables that run side by side share the executors evenly
    "spark.scheduler.mode": "FAIR",
}

# Stored bytes per shuffle partition; adaptive execution merges partitions that turn out small.
SHUFFLE_BYTES = 128 << 20

_local_folders: dict[str, str] = {}


def build_session(app_name: str = "bodega", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a cluster
    a machine-local folder would lose its files together with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="bodega-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a columnar table in the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives lost executors, and lets later passes
    read only the columns they touch.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int):
    """Enough shuffle partitions for a step over ``input_bytes``; the setting is put back after.

    The session's own number is the minimum.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), math.ceil(input_bytes / SHUFFLE_BYTES))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def open_writers(spark: SparkSession, most: int):
    """Let a write keep files of up to ``most`` partitions open in a task, so that rows that come in few partitions need
    no sort before it; the setting is put back after."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def broadcast_limit(spark: SparkSession) -> int:
    """The session's size threshold for broadcasts in bytes; -1 when they are off."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, from the file system's listing alone (no job)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def folder_files(spark: SparkSession, path: str) -> int:
    """Number of files below a folder, from the listing alone."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getFileCount()


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the lake through its own file system."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
