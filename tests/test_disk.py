"""Writes that hold the shuffles and the copies of a part of their table at a time."""

import os
import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.plans import check_sinks, registry
from tickloom.plans.derived import ship_fact
from tickloom.schema import FACT_COLUMNS
from tickloom.session import SHUFFLE_CLEANUP, shared_folder, store_in_slices, stored_bytes
from tickloom.sinks import warehouse


# Counts and listings, which are no writes, leave some bytes a task.
COUNTS = 20_000


def shuffle_files(spark):
    """Shuffle files with their sizes."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_")}


def left(spark, before):
    """Bytes of new shuffle files that are still there some seconds after; Spark deletes them in the background."""
    for _ in range(40):
        found = sum(size for name, size in shuffle_files(spark).items() if name not in before)
        if found < COUNTS:
            break
        time.sleep(0.25)
    return found


def dated(spark, rows):
    day = F.to_date("trade_date")
    df = spark.createDataFrame(rows, "symbol string, trade_date string, volume long").withColumn("trade_date", day)
    return df.withColumns({"year": F.year(day), "month": F.month(day)})


ROWS = [(s, d, v) for v, d in enumerate(["2024-01-03", "2024-01-01", "2024-02-01", "2023-01-09", None]) for s in ("B", "A", None)]


def counted(df):
    return Counter(map(tuple, df.select("symbol", F.col("trade_date").cast("string"), "volume").collect()))


def many(spark):
    return spark.range(40_000).select(
        F.hex(F.xxhash64("id")).alias("symbol"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("trade_date"),
        F.xxhash64("id").alias("volume"), F.lit(2024).alias("year"), (F.col("id") % 3).cast("int").alias("month"),
    )


def test_shuffles_of_writes_go_when_they_end(spark, tmp_path):
    rows, before = many(spark).repartition(3, "symbol"), shuffle_files(spark)
    was = spark.conf.get(SHUFFLE_CLEANUP)
    assert warehouse.append(rows, f"{tmp_path}/t") == 40_000
    assert left(spark, before) < COUNTS
    warehouse.compact(spark, f"{tmp_path}/t")
    assert left(spark, before) < COUNTS
    assert spark.conf.get(SHUFFLE_CLEANUP) == was
    # What other code writes stays for now, and is much more.
    rows.write.parquet(f"{tmp_path}/other")
    assert sum(size for name, size in shuffle_files(spark).items() if name not in before) > 10 * COUNTS


@pytest.mark.parametrize("partition_by", [("year", "month"), ("year",), ()])
def test_compaction_rewrites_some_partitions_at_a_time(spark, tmp_path, monkeypatch, partition_by):
    path = f"{tmp_path}/t"
    warehouse.append(dated(spark, ROWS), path, partition_by)
    warehouse.append(dated(spark, ROWS), path, partition_by)
    monkeypatch.setattr(warehouse, "COMPACTION_BYTES", 1, raising=False)
    warehouse.compact(spark, path, partition_by=partition_by)
    table = spark.read.parquet(path)
    assert counted(table) == counted(dated(spark, ROWS + ROWS))
    assert warehouse.profile(table).first()["overlapping_files"] == 0
    folders = {folder: [n for n in names if n.endswith(".parquet")] for folder, _, names in os.walk(path)}
    # The files of one write share the end of their name.
    writes = [{n.split("-", 2)[2].split(".")[0] for n in names} for names in folders.values() if names]
    assert len(set().union(*writes)) == len(writes) == {0: 1, 1: 3, 2: 4}[len(partition_by)]


def test_partitions_of_a_run(monkeypatch):
    def sizes(*given):
        return [[(r, size) for r, size in zip(run, [held] * len(run))] for run, held in warehouse._runs([*zip("abcdef", given)], 10)]

    assert sizes(4, 6, 1, 20, 3, 7) == [[("a", 10), ("b", 10)], [("c", 1)], [("d", 20)], [("e", 10), ("f", 10)]]
    assert sizes() == []
    monkeypatch.setattr(warehouse, "MAX_PARTITION_LITERALS", 2)
    assert [len(run) for run in sizes(1, 1, 1, 1, 1)] == [2, 2, 1]


def test_slices_hold_whole_keys_and_go_once_used(spark):
    rows, before = dated(spark, ROWS).unionByName(many(spark).withColumn("symbol", F.lit("C"))), shuffle_files(spark)
    found, folder = [], None
    for part in store_in_slices(rows.repartition(2, "trade_date"), "sliced", ["symbol"], 3):
        assert part.schema == rows.schema
        found.append(counted(part))
        folder = folder or next(f for f in os.listdir(shared_folder(spark)) if f.startswith("sliced-"))
    assert sum(found, Counter()) == counted(rows)
    symbols = [{s for s, _, _ in part} for part in found]
    assert sum(map(len, symbols)) == len(set().union(*symbols)) == 4
    assert not os.path.exists(f"{shared_folder(spark)}/{folder}")
    assert left(spark, before) < COUNTS


@pytest.fixture
def lines(spark, tmp_path):
    """Lines of five suppliers, one of them unknown, on days of three months, some twice on a day."""
    rows = [
        (100 + i, i % 3, None if i % 5 == 4 else i % 5, float(1 + i % 7), 10.0 + i, datetime(2024, 1, 1) + timedelta(days=i // 6))
        for i in range(400)
    ]
    names = "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp"
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_fact_rows_are_appended_in_slices_of_whole_series(spark, lines, monkeypatch):
    queries, _ = registry.load()
    expected = ship_fact(spark, lines).select(FACT_COLUMNS)
    monkeypatch.setattr(check_sinks, "SLICE_BYTES", stored_bytes(spark, f"{lines}/lineitem.parquet") // 3 + 1, raising=False)
    appended, append = [], warehouse.append
    monkeypatch.setattr(
        warehouse, "append", lambda df, path: (appended.append({r[0] for r in df.select("symbol").distinct().collect()}), append(df, path))
    )
    table = queries["k13_compaction"](spark, lines)
    assert table.schema.simpleString() == expected.schema.simpleString()
    assert Counter(map(str, table.collect())) == Counter(map(str, expected.collect()))
    assert len(appended) == 3 and max(map(len, appended)) < 5
    assert sum(map(len, appended)) == len(set().union(*appended)) == 5
    assert queries["k15_table_profile"](spark, lines).first().asDict() == {"row_count": expected.count(), "overlapping_files": 0}
    assert not [f for f in os.listdir(shared_folder(spark)) if f.startswith("bars-")]
