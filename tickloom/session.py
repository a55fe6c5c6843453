"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Settings the jobs rely on. Shuffle partitions are only a starting point: adaptive
# execution coalesces small ones and splits skewed joins and rebalanced writes.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Adaptive execution joins small partitions but never splits those of a window, a grouping or most joins,
    # so there must be enough of them from the start for one to fit a task.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    # A writer sorts its task's rows by partition: about eleven bytes of memory for each shuffled one.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    # Rank limits and groupings sort or hash what a task scans, before the shuffle.
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    # Lets the planner use the row counts that statistics refreshes leave in the catalog.
    "spark.sql.cbo.enabled": "true",
    # Raw JSON numbers are read as text. Copying their exact spelling would read each of them
    # from the file once more; the spelling does not matter, since they become numbers.
    "spark.sql.json.enableExactStringParsing": "false",
    # Java never compiles a method beyond 8,000 bytes. Generated code that is longer would be interpreted
    # row by row, several times slower than the same expressions in methods of their own.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def job_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """Give a session made elsewhere the settings of the jobs."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)


SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def stored_bytes(spark: SparkSession, path: str, pattern: str = "*") -> int:
    """Size of all files below a path; only the file listing is read, no content."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return listing.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def partitions_for(spark: SparkSession, size: int) -> int:
    """Enough partitions that one fits a task's memory, and never fewer than configured."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, math.ceil(size / SHUFFLE_PARTITION_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tickloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, folder: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, or to a folder in it, and read it back.

    Cuts the lineage, survives lost executors, and lets later passes read only the
    columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name) if folder is None else f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


# Folder level of the parts of a table stored in slices.
SLICE = "stored_slice"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go as it ends; else they stay until the driver happens to collect its garbage.

    For writes only: an action repeated on the same DataFrame would run its stages again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def store_in_slices(df: DataFrame, name: str, keys: Sequence[str], slices: int) -> Iterator[DataFrame]:
    """Store ``df`` and give it back in ``slices`` parts, one after the other; rows of equal keys are in one part.

    For steps that need all rows of a key, but not all keys at once: what they shuffle is then a part's only. A part is
    deleted when the next one is asked for, so use it up before.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, name)
    number = F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int")
    with shuffles_freed(spark):
        df.withColumn(SLICE, number).write.partitionBy(SLICE).parquet(folder, compression="zstd")
    stored = spark.read.schema(T.StructType([*df.schema, T.StructField(SLICE, T.IntegerType())])).parquet(folder)
    try:
        for i in range(slices):
            yield stored.filter(F.col(SLICE) == i).drop(SLICE)
            discard(spark, f"{folder}/{SLICE}={i}")
    finally:
        discard(spark, folder)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder made by ``scratch_path`` whose tables nothing reads any more."""
    if not folder.startswith(f"{shared_folder(spark)}/"):
        raise ValueError(f"not in the shared folder: {folder}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
