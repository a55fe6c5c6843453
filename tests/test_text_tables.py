"""CSV files with different headers, loads by schema, and errors by file, line and place in the line."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructType

from tickloom.sources import files, text_tables
from tests.test_files import write

SCHEMA = StructType().add("symbol", StringType()).add("day", DateType()).add("volume", LongType()).add("close", DoubleType())
LOADED = "2024-02-01 00:00:00"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def errors_of(df):
    return [
        (r["source_file"].rsplit("/", 1)[1], r["line"], r["column_name"], r["position"], r["raw_value"], r["reason"]) for r in df.collect()
    ]


def test_headers_differ_in_order_columns_and_case(spark, tmp_path):
    write(f"{tmp_path}/t/a.csv", "symbol,day,volume,close\nA,2024-01-02,5,1.5\n")
    write(f"{tmp_path}/t/b.csv", "close,volume,Symbol,extra\n2.5,7,B,x\n")
    write(f"{tmp_path}/t/c [1].csv", "﻿volume,symbol\n9,C\n")
    write(f"{tmp_path}/t/empty.csv", "")
    write(f"{tmp_path}/t/header-only.csv", "symbol,day,volume,close\n")
    loaded = files.read_for_load(spark, f"{tmp_path}/t", "CSV", schema=SCHEMA)
    assert loaded.schema.simpleString() == SCHEMA.simpleString()
    assert [(r["symbol"], str(r["day"]), r["volume"], r["close"]) for r in loaded.orderBy("symbol").collect()] == [
        ("A", "2024-01-02", 5, 1.5), ("B", "None", 7, 2.5), ("C", "None", 9, None),
    ]
    untyped = files.read_for_load(spark, f"{tmp_path}/t", "CSV")
    assert set(c.lower() for c in untyped.columns) == {"symbol", "day", "volume", "close", "extra"}
    assert untyped.count() == 3


def test_headers_without_rows_and_repeated_columns(spark, tmp_path):
    write(f"{tmp_path}/none/a.csv", "")
    assert files.read_for_load(spark, f"{tmp_path}/none", "CSV", schema=SCHEMA).count() == 0
    assert text_tables.load_errors(spark, f"{tmp_path}/none", SCHEMA, F.lit(LOADED), "CSV").count() == 0
    with pytest.raises(ValueError):
        files.read_for_load(spark, f"{tmp_path}/none", "CSV")
    write(f"{tmp_path}/twice/a.csv", "symbol,Symbol\nA,B\n")
    with pytest.raises(ValueError, match="twice"):
        text_tables.read_csv_by_name(spark, f"{tmp_path}/twice")


def test_partition_folders_and_quoted_fields(spark, tmp_path):
    write(f"{tmp_path}/p/date=1/a.csv", 'symbol,close\n"A, B",1.0\n')
    write(f"{tmp_path}/p/date=2/a.csv", "close,symbol\n2.0,C\n")
    assert rows_of(text_tables.read_csv_by_name(spark, f"{tmp_path}/p", ["symbol", "close"])) == [("A, B", "1.0"), ("C", "2.0")]


def test_json_by_schema_needs_no_inference(spark, tmp_path):
    write(f"{tmp_path}/j/a.json", '{"symbol":"A","volume":"5","close":1.5,"more":{"x":1}}\n{"symbol":"B","volume":2.5}\n{no json\n')
    loaded = files.read_for_load(spark, f"{tmp_path}/j", "JSON", schema=SCHEMA)
    assert [tuple(r) for r in loaded.where("symbol IS NOT NULL").orderBy("symbol").collect()] == [("A", None, 5, 1.5), ("B", None, 2, None)]


def test_errors_of_csv(spark, tmp_path):
    write(f"{tmp_path}/e/a.csv", 'symbol,day,volume,close\n"A, ""x""",2024-01-02,many,1.5\n\nB,never,3,1,7\nC,never,many,high\nD,,,\n')
    write(f"{tmp_path}/e/b.csv", "volume,symbol\n1,A\nx,B\n")
    found = errors_of(text_tables.load_errors(spark, f"{tmp_path}/e", SCHEMA, F.lit(LOADED), "CSV"))
    assert {r[5] for r in found} == {"not a bigint", "not a date", "not a double", "not 4 fields"}
    assert {r[:5] for r in found} == {
        ("a.csv", 2, "volume", len('"A, ""x""",2024-01-02,') + 1, "many"),
        ("a.csv", 4, None, None, "B,never,3,1,7"),
        ("a.csv", 5, "day", 3, "never"),
        ("a.csv", 5, "volume", 9, "many"),
        ("a.csv", 5, "close", 14, "high"),
        ("b.csv", 3, "volume", 1, "x"),
    }


def test_lines_are_numbered_over_all_blocks(spark, tmp_path):
    """A file cut into many blocks: every bad line has its number in the file."""
    lines = [f'{{"symbol":"S{i}","volume":{"true" if i % 50 == 7 else i}}}' if i % 91 else "{ no json" for i in range(700)]
    write(f"{tmp_path}/n/long.json", "\n".join(lines) + "\n")
    write(f"{tmp_path}/n/short.json", lines[7] + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = errors_of(text_tables.load_errors(spark, f"{tmp_path}/n", SCHEMA, F.lit(LOADED)))
        assert text_tables._lines(spark, [f"{tmp_path}/n"]).rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    values = {(f, n) for f, n, c, _, _, _ in found if c == "volume"}
    assert values == {("long.json", i + 1) for i in range(700) if i % 50 == 7 and i % 91} | {("short.json", 1)}
    assert {(f, n) for f, n, c, _, _, _ in found if c is None} == {("long.json", i + 1) for i in range(0, 700, 91)}
    assert {p - len(f'{{"symbol":"S{n - 1}","volume":') for f, n, c, p, _, _ in found if c and f == "long.json"} == {1}


def test_newest_errors_first(spark, tmp_path):
    write(f"{tmp_path}/a/a.json", '{"volume":"x"}\n' * 20)
    write(f"{tmp_path}/b/b.json", '{"volume":"y"}\n' * 3)
    later = F.to_timestamp(F.lit("2024-02-02 00:00:00"))
    errors = text_tables.load_errors(spark, f"{tmp_path}/a", SCHEMA, F.lit(LOADED)).unionByName(
        text_tables.load_errors(spark, f"{tmp_path}/b", SCHEMA, later)
    )
    newest = text_tables.latest_errors(errors).collect()
    assert [(r["raw_value"], r["line"]) for r in newest] == [("y", 1), ("y", 2), ("y", 3), *[("x", n) for n in range(1, 8)]]
    assert newest[0].asDict().keys() == set(text_tables.ERROR_COLUMNS)
