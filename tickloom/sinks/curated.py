"""Curated layer, daily snapshots, exports and the validation audit trail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tickloom.session import discard, scratch_path, store

PARTITION_COLUMNS = ("year", "month")
# A file is one task's work, and what reads a file of one row group is one task too.
FILE_BYTES = 64 * 1024 * 1024


def write_curated(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    compression: str = "snappy",
    rows_per_file: int | None = None,
) -> None:
    """Replace the partitions that occur in ``df`` and keep all others.

    The rebalance gathers each partition's rows into few files and splits partitions that
    are too large for one task. Pass a stored ``df`` if it is written more than once.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    writer = (
        rows.write.mode("overwrite")
        .option("compression", compression)
        .option("partitionOverwriteMode", "dynamic")
    )
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_sized(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Write files of at most ``rows_per_file`` rows, without counting the rows first."""
    write_curated(df, path, (), rows_per_file=rows_per_file)


def write_snapshot(df: DataFrame, target_path: str, execution_date: str, files: int = 1) -> str:
    """One execution date's snapshot in ``files`` files of about equal rows, replacing an earlier run's.

    A file is written by one task: name more than one for a table that a task cannot write in time
    (``files_for`` tells how many by its size). An empty table keeps its schema in one file.

    The task of a single file must read all rows. All tasks store them first, and it reads them as compressed columns,
    which are a fraction of the same rows in a shuffle.
    """
    path = f"{target_path}/daily_snapshots/date={execution_date}"
    folder = None
    if files == 1:
        folder = scratch_path(df.sparkSession, "snapshot-rows")
        rows = store(df, "rows", folder, compression="zstd").coalesce(1)
    else:
        rows = df.repartition(files)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    if folder:
        discard(df.sparkSession, folder)
    return path


def write_csv(df: DataFrame, path: str, files: int = 1) -> None:
    """CSV in ``files`` files of about equal rows with a header each; one task writes one file."""
    df.repartition(files).write.mode("overwrite").option("header", True).csv(path)


def files_for(size: int, bytes_per_file: int = FILE_BYTES) -> int:
    """How many files of about ``bytes_per_file`` bytes hold ``size`` bytes of data."""
    return max(1, -(-size // bytes_per_file))


def write_audit(results: DataFrame, path: str, execution_date: str) -> None:
    """Validation results as JSON by run date, replacing an earlier run of that date."""
    (
        results.withColumn("date", F.lit(execution_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .json(path)
    )
