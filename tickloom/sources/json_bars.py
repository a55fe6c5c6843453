"""Raw bars from JSON files: envelopes, top-level arrays and single objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tickloom.operators.cleanse import coerce_types
from tickloom.schema import RAW_COLUMNS, RAW_SCHEMA

CORRUPT = "_corrupt_record"

# Read as text, so that one bad number costs that value and not the whole record.
_TEXT_BAR = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
_META = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in [
            "symbol",
            "last_refreshed",
            "output_size",
            "time_zone",
            "ingestion_timestamp",
            "data_source",
        ]
    ]
)
ENVELOPE_SCHEMA = T.StructType(
    [T.StructField("meta", _META), T.StructField("data", T.ArrayType(_TEXT_BAR))]
    + _TEXT_BAR.fields
    + [T.StructField(CORRUPT, T.StringType())]
)


def json_options(
    reader: DataFrameReader | DataStreamReader, pattern: str = "*.json", multi_line: bool = True
) -> DataFrameReader | DataStreamReader:
    """One document per file, or with ``multi_line`` off one per line, which Spark can split."""
    return (
        reader.schema(ENVELOPE_SCHEMA)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )


def read_documents(
    spark: SparkSession, *paths: str, pattern: str = "*.json", multi_line: bool = True
) -> DataFrame:
    """Whole JSON documents with the file each came from."""
    documents = json_options(spark.read, pattern, multi_line).json(list(paths))
    return documents.withColumn("source_file", F.col("_metadata.file_path"))


def flatten(documents: DataFrame) -> DataFrame:
    """One row per bar: the elements of ``data``, or the document itself if it has none."""
    own = F.when(F.col("symbol").isNotNull() | F.col("timestamp").isNotNull(), F.array(F.struct(*RAW_COLUMNS)))
    return (
        documents.filter(F.col(CORRUPT).isNull())
        .select(F.explode(F.coalesce("data", own)).alias("record"), "source_file")
        .select("record.*", "source_file")
    )


def date_path(base_path: str, execution_date: str, prefix: str = "stock_data") -> str:
    """The folder of one execution date. Naming it spares listing all the others."""
    return "/".join([p.strip("/") if i else p.rstrip("/") for i, p in
                     enumerate([base_path, prefix, f"date={execution_date}"]) if p])


def read_date_partition(
    spark: SparkSession,
    base_path: str,
    execution_date: str,
    prefix: str = "stock_data",
    multi_line: bool = True,
) -> DataFrame:
    """Raw bars of one execution date, all symbols, with ``source_file``.

    The execution date is when the files were fetched, not the date of the bars in them.
    """
    return read_bars(spark, date_path(base_path, execution_date, prefix), multi_line=multi_line)


def read_bars(
    spark: SparkSession, *paths: str, pattern: str = "*.json", multi_line: bool = True
) -> DataFrame:
    documents = read_documents(spark, *paths, pattern=pattern, multi_line=multi_line)
    return coerce_types(flatten(documents))


def scan_directory(
    spark: SparkSession, path: str, pattern: str = "*.json", multi_line: bool = True
) -> DataFrame:
    """All JSON files below a folder. Unreadable ones are skipped; nothing readable is an error."""
    bars = read_bars(spark, path, pattern=pattern, multi_line=multi_line)
    if bars.isEmpty():
        raise ValueError(f"no valid JSON data found in {path}")
    return bars


def unreadable_documents(documents: DataFrame) -> DataFrame:
    """Documents that are no JSON, or only in part; ``flatten`` leaves them out."""
    return documents.filter(F.col(CORRUPT).isNotNull()).select(
        "source_file", F.col(CORRUPT).alias("record"), F.col("data").isNotNull().alias("partly_read")
    )


def text_bars(documents: DataFrame) -> DataFrame:
    """Bars before type coercion, for reporting the values that do not convert."""
    return flatten(documents)


def rejected_values(bars_as_text: DataFrame, loaded_at) -> DataFrame:
    """One row per value that does not convert to its declared type."""
    typed = coerce_types(bars_as_text.withColumns({f"_text_{c}": F.col(c) for c in RAW_COLUMNS}))
    reasons = [
        F.when(
            F.col(f"_text_{f.name}").isNotNull() & F.col(f.name).isNull(),
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"_text_{f.name}").alias("raw_value"),
                F.lit(f"not a {f.dataType.simpleString()}").alias("reason"),
            ),
        )
        for f in RAW_SCHEMA
        if f.dataType.simpleString() != "string"
    ]
    return typed.select(
        loaded_at.alias("load_time"), "source_file", "timestamp", F.inline(F.array_compact(F.array(*reasons)))
    )


def latest_load_errors(rejects: DataFrame, limit: int = 10) -> DataFrame:
    return rejects.orderBy(
        F.desc("load_time"), "source_file", "timestamp", "column_name", "raw_value"
    ).limit(limit)
