"""Loads of CSV and JSON lines by a table's schema: columns by name, values by type, errors by position.

Everything is read by Spark's own readers, so any path, split and compression they know will do. Records
are lines; a quoted line break inside a CSV field is not supported here.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import to_number

CORRUPT = "_corrupt_record"
ERROR_COLUMNS = ("load_time", "source_file", "line", "column_name", "position", "raw_value", "reason")
ERROR_SCHEMA = (
    "load_time timestamp, source_file string, line long, column_name string, position int, raw_value string, reason string"
)


def _lines(spark: SparkSession, paths: list[str], pattern: str = "*") -> DataFrame:
    """All lines below the paths with their file, block and a place that rises within the block."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def headers(spark: SparkSession, path: str, delimiter: str = ",", pattern: str = "*") -> dict[tuple[str, ...], list[str]]:
    """The files of each header: column names as they are spelled, in order.

    One scan of lines; a task sends one line per file, and the driver sees the file names that it lists
    in any read. Files without a line have no header and no rows, and are left out.
    """
    first = _lines(spark, [path], pattern).where("block = 0 AND trim(value) <> ''")
    first = first.groupBy("source_file").agg(F.min_by("value", "place").alias("header"))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("source_file")).alias("files")).collect()
    out: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(found, key=lambda r: r["header"]):
        columns = tuple(_split_header(row["header"], delimiter))
        folded = [c.lower() for c in columns]
        if len(set(folded)) < len(folded):
            raise ValueError(f"a column occurs twice in the header of {row['files'][0]}")
        out.setdefault(columns, []).extend(unquote(f) for f in row["files"])
    return out


def _split_header(line: str, delimiter: str) -> list[str]:
    return [c.strip().strip('"').strip() for c in line.lstrip("﻿").rstrip("\r").split(delimiter)]


def _literal(path: str) -> str:
    """A path whose special characters stand for themselves."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def read_csv_by_name(
    spark: SparkSession, path: str, columns: list[str] | None = None, delimiter: str = ",", pattern: str = "*"
) -> DataFrame:
    """Text columns of CSV files whose headers may differ in order or in columns.

    Files of one header are one scan; a column that a file lacks is NULL there. With ``columns`` the
    result has these and no others, matched without regard to case, also if there is no file. Without,
    it has all columns of all headers, by first appearance in the sorted headers.
    """
    found = headers(spark, path, delimiter, pattern)
    if columns is None:
        if not found:
            raise ValueError(f"no header in {path}")
        spelled: dict[str, str] = {}
        for header in found:
            for c in header:
                spelled.setdefault(c.lower(), c)
        columns = list(spelled.values())
    scans = []
    for header, files in found.items():
        own = {c.lower(): c for c in header}
        reader = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in header]))
        rows = reader.option("header", True).option("sep", delimiter).csv([_literal(f) for f in files])
        scans.append(
            rows.select(
                *[(F.col(f"`{own[c.lower()]}`") if c.lower() in own else F.lit(None).cast("string")).alias(c) for c in columns]
            )
        )
    if not scans:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reduce(DataFrame.unionByName, scans)


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a table's schema; a text that does not convert is NULL, as is a column that is lacking."""
    own = {c.lower(): c for c in rows.columns}
    return rows.select(
        *[
            (_convert(f"`{own[f.name.lower()]}`", f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def _convert(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.col(name).cast("string")
    if isinstance(kind, (T.LongType, T.IntegerType, T.DoubleType)):
        return to_number(name, kind.simpleString())
    return F.col(name).try_cast(kind)


def read_json_by_name(spark: SparkSession, path: str, columns: list[str], pattern: str = "*") -> DataFrame:
    """Text columns of JSON lines; the schema is given, so no pass infers one."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("pathGlobFilter", pattern).json(path)


def load_errors(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    loaded_at: Column,
    file_format: str = "JSON",
    delimiter: str = ",",
    pattern: str = "*",
) -> DataFrame:
    """A row per value or line that a load by ``schema`` could not take.

    ``line`` and ``position`` count from 1 in the file and in the line. Lines that are no JSON, or have another
    number of fields than their header, have no column and no position. Empty lines are no errors.

    Lines are numbered in two scans of the same splits: one counts the lines of every block, the other finds
    the errors, and only these meet the counts.
    """
    if file_format == "JSON":
        return _json_errors(spark, path, schema, loaded_at, pattern)
    if file_format != "CSV":
        raise ValueError(f"file format must be CSV or JSON, not {file_format!r}")
    parts = [
        _csv_errors(spark, header, [_literal(f) for f in files], schema, loaded_at, delimiter)
        for header, files in headers(spark, path, delimiter, pattern).items()
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], ERROR_SCHEMA)


def _json_errors(spark, path, schema, loaded_at, pattern):
    lines = _lines(spark, [path], pattern)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", text, {"columnNameOfCorruptRecord": CORRUPT})
    before = {f.name: rf'(?s)^.*?(?<!\\)"{_quoted(f.name)}"\s*:\s*' for f in schema}
    return _numbered(lines, parsed, schema, "no JSON", before, loaded_at)


def _csv_errors(spark, header, files, schema, loaded_at, delimiter):
    lines = _lines(spark, files)
    text = T.StructType([T.StructField(c, T.StringType()) for c in header] + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_csv("value", F.lit(_ddl(text)), {"sep": delimiter, "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    cut = _quoted(delimiter)
    at = {c.lower(): i for i, c in enumerate(header)}
    own = T.StructType([T.StructField(header[at[f.name.lower()]], f.dataType) for f in schema if f.name.lower() in at])
    before = {f.name: rf'^(?:(?:"(?:[^"]|"")*"|(?:(?!{cut}).)*){cut}){{{at[f.name.lower()]}}}' for f in own}
    found = _numbered(lines, parsed, own, f"not {len(header)} fields", before, loaded_at)
    return found.where("line > 1")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)


def _quoted(text: str) -> str:
    """A regular expression for exactly this text."""
    return "".join(c if c.isalnum() or c == "_" else f"\\{c}" for c in text)


def _numbered(lines, parsed, schema, broken, before, loaded_at):
    record = lines.where("trim(value) <> ''").withColumn("r", parsed)
    record = record.select("source_file", "block", "place", "value", "r.*")
    unread = F.struct(
        F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("int").alias("position"),
        F.col("value").alias("raw_value"), F.lit(broken).alias("reason"),
    )
    errors = [F.when(F.col(CORRUPT).isNotNull(), unread)]
    for f in schema:
        if isinstance(f.dataType, T.StringType):
            continue
        wrong = F.col(CORRUPT).isNull() & F.col(f"`{f.name}`").isNotNull() & _convert(f"`{f.name}`", f.dataType).isNull()
        where = (F.length(F.regexp_extract("value", before[f.name], 0)) + 1).cast("int")
        what = F.lit(f"not a {f.dataType.simpleString()}")
        shown = F.struct(
            F.lit(f.name).alias("column_name"), where.alias("position"), F.col(f"`{f.name}`").alias("raw_value"), what.alias("reason")
        )
        errors.append(F.when(wrong, shown))
    found = record.select("source_file", "block", "place", F.inline(F.array_compact(F.array(*errors))))
    sizes = lines.groupBy("source_file", "block").agg(F.min("place").alias("first"), F.count("*").alias("lines"))
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("source_file", "block", "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    line = F.col("before") + F.col("place") - F.col("first") + 1
    return found.join(starts, ["source_file", "block"]).select(
        loaded_at.cast("timestamp").alias("load_time"), "source_file", line.alias("line"),
        "column_name", "position", "raw_value", "reason",
    )


def latest_errors(errors: DataFrame, limit: int = 10) -> DataFrame:
    """The errors of the newest loads, in order of file, line and place in the line."""
    return errors.orderBy(F.desc("load_time"), "source_file", "line", "position", "column_name").limit(limit)
