"""Versioned tables: atomic commits, moved keys, last writer wins, compaction."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tickloom.sinks import versioned
from tickloom.sinks.versioned import VersionConflict, VersionedTable
from tickloom.sinks.warehouse import LoadError, profile


def keyed(spark, rows):
    frame = spark.createDataFrame(rows, "price_id string, trade_date string, volume long")
    day = F.to_date("trade_date")
    return frame.withColumns({"trade_date": day, "year": F.year(day), "month": F.month(day)})


def volumes(table):
    return sorted((r.price_id, r.volume) for r in table.read().collect())


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, f"{tmp_path}/t")
    return made.append(keyed(spark, [("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", "2024-02-01", 1)]))


def stored_files(table):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table.path}/data/**/*.parquet", recursive=True)}


def test_upsert_rewrites_only_units_that_hold_a_key(spark, table):
    before = stored_files(table)
    table.upsert(keyed(spark, [("b", "2024-01-02", 2), ("d", "2024-01-03", 2)]), fixed_partition=True)
    assert volumes(table) == [("a", 1), ("b", 2), ("c", 1), ("d", 2)]
    assert before.items() <= stored_files(table).items()
    assert sum("month=2" in r.unit for r in table.units().collect()) == 1
    units = {r.unit for r in table.units().collect()}
    table.upsert(keyed(spark, [("e", "2024-01-09", 3)]), fixed_partition=True)
    assert units < {r.unit for r in table.units().collect()}
    with pytest.raises(LoadError):
        table.upsert(keyed(spark, [("e", "2024-01-02", 2)] * 2))
    with pytest.raises(LoadError):
        table.upsert(keyed(spark, [("e", "2024-01-02", 2)]).drop("volume"))


def test_a_moved_key_is_stored_once(spark, table):
    table.upsert(keyed(spark, [("a", "2024-03-05", 7)]))
    assert volumes(table) == [("a", 7), ("b", 1), ("c", 1)]
    assert {r.month for r in table.read().where("price_id = 'a'").collect()} == {3}


def test_a_driver_lost_before_the_commit_leaves_the_table_as_it_was(spark, table, monkeypatch):
    for broken in ("create", "names"):
        with monkeypatch.context() as m:
            if broken == "create":
                m.setattr(versioned._Files, "create", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
            else:
                m.setattr(VersionedTable, "_write", lambda self, rows, *a: (rows.write.parquet(f"{self.path}/data/commit=00000000000000000002-x"), 1 / 0))
            with pytest.raises((KeyboardInterrupt, ZeroDivisionError)):
                table.upsert(keyed(spark, [("a", "2024-01-01", 9)]))
        again = VersionedTable(spark, table.path)
        assert again.version == 1 and volumes(again) == [("a", 1), ("b", 1), ("c", 1)]
    again.upsert(keyed(spark, [("a", "2024-01-01", 9)]))
    assert len(again.expire(keep=1)) >= 2
    assert volumes(VersionedTable(spark, table.path)) == [("a", 9), ("b", 1), ("c", 1)]


def test_of_two_writers_one_starts_anew(spark, table):
    one, two = VersionedTable(spark, table.path), VersionedTable(spark, table.path)
    one.insert_if_absent(keyed(spark, [("n", "2024-01-05", 1)]))
    staged = keyed(spark, [("n", "2024-01-05", 2), ("m", "2024-01-05", 2), ("m", "2024-01-05", 2)])
    with pytest.raises(VersionConflict):
        two.insert_if_absent(staged)
    versioned.retrying(lambda: VersionedTable(spark, table.path).insert_if_absent(staged))
    assert volumes(VersionedTable(spark, table.path)) == [("a", 1), ("b", 1), ("c", 1), ("m", 2), ("n", 1)]


def test_earlier_versions_stay_readable(spark, table):
    table.upsert(keyed(spark, [("a", "2024-01-01", 5)])).replace_date(keyed(spark, [("z", "2024-02-01", 8)]), "2024-02-01")
    assert volumes(table) == [("a", 5), ("b", 1), ("z", 8)]
    assert volumes(table.at(1)) == [("a", 1), ("b", 1), ("c", 1)]
    assert [h["operation"] for h in table.history()] == ["append", "upsert", "replace date"]
    for rows in ([("y", "2024-01-03", 9)], []):
        with pytest.raises(LoadError):
            table.replace_date(keyed(spark, rows), "2024-01-02")


def test_the_newer_row_of_a_key_stays(spark, tmp_path):
    kind = "price_id string, source string, volume long"
    frames = [spark.createDataFrame(rows, kind) for rows in ([("a", "2", 2), ("b", "1", 1)], [("a", "1", 1), ("b", "2", 2)], [("a", None, 0)])]
    table = VersionedTable(spark, f"{tmp_path}/t", ())
    for frame in frames[:2]:
        table.upsert(frame, newer="source")
    assert volumes(table) == [("a", 2), ("b", 2)]
    version = table.version
    table.upsert(spark.createDataFrame([("a", "1", 7)], kind), newer="source")
    assert table.version == version and volumes(table) == [("a", 2), ("b", 2)]


def test_null_keys_null_partitions_and_odd_names(spark, tmp_path):
    kind = "price_id string, part string, volume long"
    table = VersionedTable(spark, f"{tmp_path}/t", ("part",))
    names = [None, "a b", "x/y", "50%+1", "é=ü"]
    table.upsert(spark.createDataFrame([(f"k{i}", n, i) for i, n in enumerate(names)] + [(None, "a b", 8)], kind))
    table.upsert(spark.createDataFrame([(f"k{i}", n, i + 10) for i, n in enumerate(names)] + [(None, "a b", 9)], kind), fixed_partition=True)
    got = {(r.price_id, r.part, r.volume) for r in table.read().collect()}
    assert got == {(f"k{i}", n, i + 10) for i, n in enumerate(names)} | {(None, "a b", 9)}
    assert table.units().count() == 5


def test_compaction_leaves_large_units_untouched(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    big = spark.range(60000).select(F.sha2(F.col("id").cast("string"), 256).alias("price_id"), F.lit("2024-01-01").alias("trade_date"), F.col("id").alias("volume"))
    table.append(keyed(spark, big.rdd.map(tuple).collect()))
    for day in range(1, 6):
        table.append(keyed(spark, [(f"s{day}", f"2024-02-{day:02}", day), (f"t{day}", f"2024-02-{6 - day:02}", day)]))
    rows, before = sorted(map(tuple, table.read().collect())), stored_files(table)
    overlaps = profile(table.read()).first()["overlapping_files"]
    assert table.compact(target_bytes=1 << 20) == 5
    assert sorted(map(tuple, table.read().collect())) == rows
    assert before.items() <= stored_files(table).items()
    months = [r.unit.split("/")[-1] for r in table.units().collect()]
    assert sorted(months) == ["month=1", "month=2"]
    assert profile(table.read()).first()["overlapping_files"] <= overlaps
    assert table.compact(target_bytes=1 << 20) == 0


def test_an_empty_commit_and_a_missing_table(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    with pytest.raises(LoadError):
        table.read()
    table.upsert(keyed(spark, []))
    assert table.read().columns == ["price_id", "trade_date", "volume", "year", "month"] and table.read().count() == 0
    table.upsert(keyed(spark, [("a", "2024-01-01", 1)]))
    assert volumes(table) == [("a", 1)]


def test_statistics_are_merged_and_only_new_units_are_read(spark, table):
    assert table.analyze(["price_id", "volume"]) == 2 and table.analyze(["price_id", "volume"]) == 0
    table.append(keyed(spark, [("a", "2024-03-01", 10), ("z", "2024-03-02", None)]))
    before = {r.column_name: r for r in table.statistics().collect()}
    assert before["volume"].stats_off == 40.0 and before["volume"].high == "1"
    assert table.analyze(["price_id", "volume"]) == 1
    now = {r.column_name: r for r in table.statistics().collect()}
    assert [(now[c].row_count, now[c].nulls, now[c].low, now[c].high, now[c].distinct_values) for c in ("price_id", "volume")] == [
        (5, 0, "a", "z", 4), (5, 1, "1", "10", 2),
    ]
    assert now["volume"].stats_off == 0.0
    table.upsert(keyed(spark, [("c", "2024-02-01", 3)]), fixed_partition=True)
    assert table.statistics().first().row_count == 4


def test_a_manifest_is_made_without_sorting_the_rows(spark, tmp_path):
    from datetime import date

    from tickloom.sinks.versioned import open_table

    rows = spark.createDataFrame([(date(2024, 1, d), d, 2024, 1) for d in (9, 10, 2)], "trade_date date, n int, year int, month int")
    table = open_table(spark, f"{tmp_path}/t")
    units = table._write(rows, "c")
    assert [(u.row_count, u.low, u.high) for u in units.collect()] == [(3, "2024-01-02", "2024-01-10")]
    plan = units._jdf.queryExecution().executedPlan().toString().splitlines()
    # Texts are compared only in the second grouping, which has one row per file.
    by_day = [line for line in plan if "Aggregate" in line and "trade_date" in line]
    assert by_day and not any("SortAggregate" in line for line in by_day)


def test_shuffles_start_with_many_partitions(spark):
    from tickloom.session import apply_settings
    from tickloom.streaming import ingest

    apply_settings(spark)
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 512
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with ingest._adaptive(spark):
            assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
