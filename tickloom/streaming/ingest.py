"""Incremental ingest: new raw files are cleansed and merged into a table of bars.

The checkpoint remembers which files were read. Each micro-batch is an upsert by key into a versioned
table, so a batch that is repeated after a failure leaves the table as it was. Every row keeps the
version of the file it came from, and a row of an older file never replaces one of a newer file: any
order and batching of the same files gives the same table.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.scalars import standard_symbol
from tickloom.operators.cleanse import cleanse, coerce_types
from tickloom.operators.enrich import standardise_dates
from tickloom.session import store
from tickloom.sinks.versioned import VersionedTable, retrying
from tickloom.sources.json_bars import flatten, json_options

BAR_KEYS = ("symbol", "timestamp")


SOURCE_VERSION = "source_version"


def source_version() -> Column:
    """Orders files by the date in their path, then by the path."""
    day = F.regexp_extract("source_file", r"date=(\d{4}-\d{2}-\d{2})", 1)
    return F.concat_ws(" ", F.rpad(day, 10, " "), F.col("source_file"))


def newest_bars(bars: DataFrame) -> DataFrame:
    """Of bars with the same key those of the newest file: by the date in its path, then by its path.

    Spark applies the rank limit before the shuffle too.
    """
    key = (standard_symbol("symbol"), F.col("timestamp"))
    ranked = Window.partitionBy(*key).orderBy(F.desc(SOURCE_VERSION))
    bars = bars.withColumn(SOURCE_VERSION, source_version())
    return bars.withColumn("_rank", F.rank().over(ranked)).filter("_rank <= 1").drop("_rank")


def bar_rows(documents: DataFrame) -> DataFrame:
    """Cleansed, dated bars with the partition columns of their table."""
    dated = standardise_dates(cleanse(newest_bars(coerce_types(flatten(documents)))))
    return dated.withColumns({"year": F.year("trade_date"), "month": F.month("trade_date")})


@contextmanager
def _adaptive(stream: SparkSession) -> Iterator[None]:
    """Plan a batch's own queries as adaptively as any other.

    A stream's session has a fixed number of shuffle partitions, kept in its checkpoint, which would
    hold ever more rows each the larger a batch is.
    """
    before = stream.conf.get("spark.sql.adaptive.enabled")
    stream.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        stream.conf.set("spark.sql.adaptive.enabled", before)


def ingest_new_files(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    checkpoint_path: str,
    files_per_batch: int = 1_000,
    multi_line: bool = True,
) -> StreamingQuery:
    """Start reading the files that arrived since the last run; it stops when all are merged."""

    def merge(documents: DataFrame, _batch: int) -> None:
        with _adaptive(documents.sparkSession):
            rows = store(bar_rows(documents), "batch")
        if not rows.isEmpty():
            # Cleansing leaves one row per key, and a bar's date is part of its key.
            retrying(
                lambda: VersionedTable(spark, table_path).upsert(
                    rows, BAR_KEYS, fixed_partition=True, newer=SOURCE_VERSION, check_unique=False
                )
            )

    documents = (
        json_options(spark.readStream, multi_line=multi_line)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(source_path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    return (
        documents.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
