"""Tables from files by format, SQL over a path, snapshots and file inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pyspark.sql import types as T

from tickloom.operators.cleanse import coerce_types
from tickloom.sources import text_tables
from tickloom.sources.json_bars import read_bars


def read_csv_bars(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Raw bars from CSV; columns go by each file's own header, values convert or become NULL."""
    return coerce_types(text_tables.read_csv_by_name(spark, path, delimiter=delimiter))


def read_by_extension(spark: SparkSession, path: str) -> DataFrame:
    """Raw bars from a .json, .csv or .parquet path; others are tried as JSON, then as CSV."""
    bare = path.rstrip("/").lower()
    if bare.endswith(".json"):
        return read_bars(spark, path).drop("source_file")
    if bare.endswith(".csv"):
        return read_csv_bars(spark, path)
    if bare.endswith(".parquet"):
        return spark.read.parquet(path)
    # A look at the first line spares reading large CSV files as one document.
    first = spark.read.text(path).select(F.ltrim("value").alias("line")).filter("line <> ''").head()
    if first is not None and first["line"][0] in "{[":
        bars = read_bars(spark, path, pattern="*").drop("source_file")
        if not bars.isEmpty():
            return bars
    return read_csv_bars(spark, path)


def read_for_load(
    spark: SparkSession,
    path: str,
    file_format: str = "PARQUET",
    delimiter: str = ",",
    json_paths: dict[str, str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """What a table load reads: Parquet, CSV by each file's header line, or JSON lines.

    JSON goes by field names, or by a JSON path per column, such as ``{"close": "$.bar.c"}``. With the
    ``schema`` of the table, the result has its columns and types: what does not convert is NULL, and
    ``text_tables.load_errors`` reports it. Without, CSV is text and JSON types are inferred by a pass
    of their own.
    """
    names = None if schema is None else schema.names
    if file_format == "PARQUET":
        rows = spark.read.parquet(path)
    elif file_format == "CSV":
        rows = text_tables.read_csv_by_name(spark, path, names, delimiter)
    elif file_format == "JSON" and json_paths:
        picked = [F.get_json_object("value", p).alias(c) for c, p in json_paths.items()]
        rows = spark.read.text(path).select(picked)
    elif file_format == "JSON":
        rows = spark.read.json(path) if names is None else text_tables.read_json_by_name(spark, path, names)
    else:
        rows = None
    if rows is not None:
        return rows if schema is None else text_tables.typed(rows, schema)
    raise ValueError(f"file format must be PARQUET, CSV or JSON, not {file_format!r}")


def query_parquet(spark: SparkSession, path: str, sql: str, name: str = "bars") -> DataFrame:
    """Run SQL over a Parquet path, which the statement calls ``{name}``."""
    return spark.sql(sql.replace("{" + name + "}", "{table}"), table=spark.read.parquet(path))


def read_snapshot(spark: SparkSession, target_path: str, execution_date: str) -> DataFrame:
    """The snapshot of one execution date; other dates are pruned before any file is read."""
    snapshots = spark.read.option("basePath", f"{target_path}/daily_snapshots").parquet(
        f"{target_path}/daily_snapshots/date={execution_date}"
    )
    return snapshots.drop("date")


def file_inventory(table: DataFrame) -> DataFrame:
    """One row per file a table reads: path, bytes and rows."""
    return table.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count("*").alias("row_count"))


def output_summary(table: DataFrame) -> DataFrame:
    """One row: files, rows and megabytes of an output."""
    return file_inventory(table).agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.round(F.coalesce(F.sum("bytes"), F.lit(0)) / (1024 * 1024), 2).alias("megabytes"),
    )


def require_output(table: DataFrame) -> dict[str, float]:
    """The summary of an output, or an error if it has no files."""
    summary = output_summary(table).first().asDict()
    if summary["files"] == 0:
        raise FileNotFoundError("the output holds no files")
    return summary
