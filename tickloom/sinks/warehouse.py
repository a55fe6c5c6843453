"""Warehouse tables as partitioned Parquet: load, upsert, replace, insert, compact, profile.

Writes go through Spark's own commit: tasks write aside, and the job puts the new partitions
in place once all tasks are done, so a lost executor costs a retry and never a half-written
partition. Only partitions that incoming rows touch are read and rewritten.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tickloom.operators.cleanse import deduplicate
from tickloom.schema import WAREHOUSE_SCHEMA
from tickloom.session import partitions_for, shuffles_freed, store, stored_bytes
from tickloom.sinks.curated import PARTITION_COLUMNS, write_curated
from tickloom.sources.files import output_summary

MAX_PARTITION_LITERALS = 1_000
# Stored bytes that a compaction rewrites at a time, in whole partitions; its shuffle is two to three times as large.
COMPACTION_BYTES = 1024 * 1024 * 1024


class LoadError(Exception):
    """Raised when a load would leave the table wrong."""


def _existing(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table, or an empty one of the incoming schema if it does not exist yet.

    A stored column that the incoming rows lack would be lost from the partitions they touch.
    """
    try:
        lacking = [c for c in spark.read.parquet(path).columns if c not in like.columns]
        if lacking:
            raise LoadError(f"the table at {path} has columns the incoming rows lack: {lacking}")
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def touched(target: DataFrame, incoming: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The part of the target that lies in partitions the incoming rows fall in."""
    if not partition_by:
        return target
    values = incoming.select(*partition_by).distinct()
    few = values.limit(MAX_PARTITION_LITERALS + 1).collect()
    if len(few) > MAX_PARTITION_LITERALS:
        # NULL is a partition like any other, so it must match here as it does below.
        values = values.select([F.col(c).alias(f"_{c}") for c in partition_by])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partition_by]
        return target.join(values, reduce(lambda a, b: a & b, same), "left_semi")
    return _within(target, few, partition_by)


def _within(table: DataFrame, partitions: Sequence[Row], partition_by: Sequence[str]) -> DataFrame:
    wanted = [
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(row[c])) for c in partition_by])
        for row in partitions
    ]
    return table.filter(reduce(lambda a, b: a | b, wanted, F.lit(False)))


def _replace(rows: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    spark = rows.sparkSession
    if not partition_by:
        # The whole table is replaced, so the new rows must lie elsewhere before it goes.
        rows = store(rows, "replacement")
    write_curated(rows, path, partition_by)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(rows.schema).parquet(path)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1).limit(5).collect()
    if repeated:
        raise LoadError(f"keys {list(keys)} occur more than once, e.g. {repeated}")


def append(
    df: DataFrame, path: str, partition_by: Sequence[str] = PARTITION_COLUMNS
) -> int:
    """Append rows; returns how many the whole table then has."""
    writer = df.hint("rebalance", *partition_by).write.mode("append") if partition_by else df.write.mode("append")
    spark = df.sparkSession
    with shuffles_freed(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(df.schema).parquet(path).count()


def merged(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in staging, and all of staging."""
    kept = target.join(staging.select(*keys), list(keys), "left_anti")
    return kept.select(staging.columns).unionByName(staging)


def upsert(
    staging: DataFrame,
    path: str,
    keys: Sequence[str] = ("price_id",),
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    check_unique: bool = True,
) -> DataFrame:
    """Replace rows by key and add new ones; returns the table.

    A key must fix its partition, as ``price_id`` does with its date. ``staging`` is read
    up to three times, so pass a stored one.
    """
    if check_unique:
        require_unique(staging, keys)
    target = touched(_existing(staging.sparkSession, path, staging), staging, partition_by)
    return _replace(merged(target, staging, keys), path, partition_by)


def replace_date(
    rows: DataFrame, path: str, trade_date: str, partition_by: Sequence[str] = PARTITION_COLUMNS
) -> DataFrame:
    """Replace one trade date. All rows must be of that date, and there must be some."""
    day = F.to_date(F.lit(trade_date))
    scope = rows.agg(F.count("*").alias("n"), F.count_if(F.col("trade_date") != day).alias("other")).first()
    if scope["n"] == 0 or scope["other"]:
        raise LoadError(
            f"{scope['n']} rows given for {trade_date}, of which {scope['other']} have another date"
        )
    target = touched(_existing(rows.sparkSession, path, rows), rows, partition_by)
    kept = target.filter(F.col("trade_date") != day).select(rows.columns)
    return _replace(kept.unionByName(rows), path, partition_by)


def absent(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One staging row per key that the target does not have."""
    fresh = staging.join(target.select(*keys), list(keys), "left_anti")
    return deduplicate(fresh.select(staging.columns), tuple(keys))


def insert_if_absent(
    staging: DataFrame,
    path: str,
    keys: Sequence[str] = ("symbol", "timestamp"),
    partition_by: Sequence[str] = PARTITION_COLUMNS,
) -> int:
    """Append the rows whose key the table lacks; returns the table's row count."""
    target = touched(_existing(staging.sparkSession, path, staging), staging, partition_by)
    # Stored first, so that the append does not read the files it adds.
    return append(store(absent(target, staging, keys), "inserts"), path, partition_by)


def compact(
    spark: SparkSession,
    path: str,
    sort_by: Sequence[str] = ("trade_date", "symbol"),
    partition_by: Sequence[str] = PARTITION_COLUMNS,
    compression: str = "snappy",
) -> None:
    """Rewrite the table sorted by its sort key, so that statistics prune row groups.

    Rows are spread by ranges of the sort key: one hot date or symbol spans many tasks. Partitions are rewritten some at
    a time: beside the table, the disk holds the shuffle and the new files of about ``COMPACTION_BYTES`` of it, or of a
    single partition that is larger.
    """
    table = spark.read.parquet(path)
    sizes = _partition_sizes(spark, path, partition_by)
    total = sum(size for _, size in sizes)
    spread = partitions_for(spark, total)
    for partitions, size in _runs(sizes, COMPACTION_BYTES):
        rows = _within(table, partitions, partition_by) if partition_by else table
        rows = rows.repartitionByRange(math.ceil(spread * size / max(total, 1)) or 1, *partition_by, *sort_by)
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
        with shuffles_freed(spark):
            if not partition_by:
                rows = store(rows, "compacted")
            writer = rows.write.mode("overwrite").option("compression", compression)
            if partition_by:
                writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
            writer.parquet(path)
    spark.catalog.refreshByPath(path)


def _partition_sizes(spark: SparkSession, path: str, partition_by: Sequence[str]) -> list[tuple[Row, int]]:
    """The partitions of a table in their order, each with its stored bytes; only the file listing is read."""
    if not partition_by:
        return [(Row(), stored_bytes(spark, path, "*.parquet"))]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    found = files.groupBy(*partition_by).agg(F.sum("length").alias("_bytes")).orderBy(*partition_by)
    return [(row, row["_bytes"]) for row in found.collect()]


def _runs(sizes: Sequence[tuple[Row, int]], most: int) -> Iterator[tuple[list[Row], int]]:
    """Partitions one after another, as many at a time as have at most ``most`` bytes together, at least one."""
    run, held = [], 0
    for row, size in sizes:
        if run and (held + size > most or len(run) == MAX_PARTITION_LITERALS):
            yield run, held
            run, held = [], 0
        run.append(row)
        held += size
    if run:
        yield run, held


def create_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType = WAREHOUSE_SCHEMA,
    partition_by: Sequence[str] = PARTITION_COLUMNS,
) -> None:
    """Declare a catalog table over a path, if there is none of that name yet."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitions} LOCATION '{path}'")


def register(spark: SparkSession, name: str, path: str) -> None:
    """Make the table at a path, as it is, a catalog table and let it see all its partitions."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    refresh_partitions(spark, name)


def refresh_partitions(spark: SparkSession, name: str) -> None:
    """Make partitions known that were written to the path of a catalog table."""
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def save_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    buckets: int,
    key: str = "symbol",
    sort_by: Sequence[str] = ("symbol", "trade_date"),
) -> None:
    """A catalog table distributed by key: windows and joins on the key then need no shuffle.

    For daily bars. A bucket is one task's work, so a symbol with a large share of all
    rows belongs into a table partitioned by date instead.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(*sort_by)
        .saveAsTable(name)
    )


def analyze(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> None:
    """Refresh the optimizer's statistics of a catalog table."""
    scope = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS {scope}")


def profile(table: DataFrame, sort_by: str = "trade_date") -> DataFrame:
    """One row: files, rows, megabytes, and how many files overlap an earlier one of their folder.

    Overlaps are counted per folder, so no task sees more than one partition's files.
    """
    path = F.col("_metadata.file_path")
    ranges = table.groupBy(
        F.regexp_replace(path, "/[^/]*$", "").alias("folder"), path.alias("file_path")
    ).agg(F.min(sort_by).alias("low"), F.max(sort_by).alias("high"))
    earlier = (
        Window.partitionBy("folder")
        .orderBy("low", "high", "file_path")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    overlapping = ranges.withColumn("_reached", F.max("high").over(earlier)).agg(
        F.count_if(F.col("low") < F.col("_reached")).alias("overlapping_files")
    )
    return output_summary(table).withColumn("overlapping_files", overlapping.scalar())
