"""Increments equal one full run; the stream gives one table for any order of the files; the gate sees every file."""

import itertools
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.operators import file_gate, quality as q
from tickloom.plans.jobs import JobConfig, curate, require_dates
from tickloom.schema import RAW_COLUMNS
from tickloom.sinks.versioned import VersionedTable, open_table
from tickloom.sinks.warehouse import LoadError
from tickloom.sources import json_bars
from tickloom.streaming.ingest import ingest_new_files
from tests.conftest import RAW_ROW


def land(base, run_date, rows, name="a"):
    folder = f"{base}/stock_data/date={run_date}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as file:
        json.dump({"meta": {}, "data": rows}, file)


def series(symbol, first, count):
    from datetime import date, timedelta

    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(first, first + count)]
    return [{**RAW_ROW, "symbol": symbol, "timestamp": str(d), "close_price": 100.0 + (d.toordinal() * 7919 % 101), "volume": d.toordinal() % 97} for d in days]


NOW = datetime(2024, 2, 1)


def facts(spark, target):
    return sorted(map(repr, open_table(spark, f"{target}/processed").read().drop("processing_timestamp").collect()))


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("whole"))
    land(base, "2024-06-01", series("AAA", 0, 150) + series("BBB", 20, 90) + series("CCC", 0, 60))
    curate(spark, JobConfig(base, f"{base}/out", "2024-06-01"), NOW)
    return facts(spark, f"{base}/out")


@pytest.mark.parametrize("order", ["in time", "late", "tail lost"])
def test_increments_equal_one_run(spark, tmp_path, whole, order):
    base, target = str(tmp_path), f"{tmp_path}/out"
    parts = [
        series("AAA", 0, 70) + series("CCC", 0, 60),
        series("AAA", 70, 3) + series("BBB", 20, 50),
        series("AAA", 73, 77) + series("BBB", 70, 40),
    ]
    if order == "late":
        # The middle of AAA comes last, and BBB backwards.
        parts = [parts[0] + series("BBB", 70, 40), series("AAA", 80, 70), series("AAA", 70, 10) + series("BBB", 20, 50)]
    for i, rows in enumerate(parts):
        land(base, f"2024-06-0{i + 1}", rows)
        if order == "tail lost" and i == 2:
            # As if the run before had ended between its two commits.
            tail = VersionedTable(spark, f"{target}/tail", ())
            tail.replace_all(tail.read().limit(1), "tail of version 1")
        summary = curate(spark, JobConfig(base, target, f"2024-06-0{i + 1}"), NOW)
        assert summary["rows_enriched"] == len(rows)
    assert facts(spark, target) == whole


def test_a_repeated_increment_changes_nothing(spark, tmp_path, whole):
    base, target = str(tmp_path), f"{tmp_path}/out"
    land(base, "2024-06-01", series("AAA", 0, 75) + series("BBB", 20, 90) + series("CCC", 0, 60))
    land(base, "2024-06-02", series("AAA", 75, 75))
    for day in ("2024-06-01", "2024-06-02", "2024-06-02", "2024-06-01"):
        curate(spark, JobConfig(base, target, day), NOW)
    assert facts(spark, target) == whole


def test_settings_are_restored(spark, tmp_path):
    land(str(tmp_path), "2024-06-01", series("AAA", 0, 5))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    curate(spark, JobConfig(str(tmp_path), f"{tmp_path}/out", "2024-06-01"), NOW)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_every_staged_date_must_be_loaded(spark):
    frame = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "trade_date string")
    require_dates(frame, frame)
    with pytest.raises(LoadError, match="2024-01-02"):
        require_dates(frame.limit(1), frame)


def test_any_order_of_the_files_gives_one_table(spark, tmp_path):
    versions = {"2024-03-01": 1, "2024-03-02": 2, "2024-03-03": 3}
    seen = set()
    for number, order in enumerate(list(itertools.permutations(versions))[::2]):
        base = f"{tmp_path}/{number}"
        for day in order:
            rows = [{**RAW_ROW, "timestamp": f"2024-01-0{d}", "volume": versions[day]} for d in range(versions[day], 4)]
            land(base, day, rows)
            ingest_new_files(spark, base, f"{base}-table", f"{base}-progress").awaitTermination()
        table = open_table(spark, f"{base}-table").read()
        seen.add(tuple(sorted((r.timestamp, r.volume) for r in table.collect())))
    assert seen == {(("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3))}


@pytest.fixture
def folder(tmp_path):
    def put(name, text):
        with open(f"{tmp_path}/{name}.json", "w") as file:
            file.write(text)

    put("good", json.dumps({"meta": {}, "data": [RAW_ROW, RAW_ROW]}))
    put("empty", json.dumps({"meta": {}, "data": []}))
    put("nothing", "")
    put("broken", '{"data": [{"symbol": "A"')
    put("poor", json.dumps([{k: RAW_ROW[k] for k in ("symbol", "timestamp", "open_price")}]))
    put("single", json.dumps({**RAW_ROW, "close_price": None}))
    return str(tmp_path)


def test_the_gate_sees_every_listed_file(spark, folder):
    rows = json_bars.read_bars(spark, folder)
    results = file_gate.evaluate_files(spark, folder, q.FULL_SUITE, rows)
    named = results.withColumn("file", F.regexp_extract("source_file", r"([a-z]+)\.json$", 1)).drop("source_file")
    counts = {r.file: (r.n, r.bad) for r in named.groupBy("file").agg(F.count("*").alias("n"), F.count_if(~F.col("success")).alias("bad")).collect()}
    assert counts == {"good": (17, 0), "empty": (17, 17), "nothing": (18, 18), "broken": (18, 18), "poor": (17, 11), "single": (17, 1)}
    verdict = q.verdict(q.report(results, by=["source_file"])).first()
    assert (verdict.files, verdict.passed_files, verdict.overall_success) == (6, 1, False)
    plain = q.evaluate(rows.filter("source_file LIKE '%good.json'").drop("source_file"), q.FULL_SUITE).drop("details").collect()
    assert sorted(named.filter("file = 'good'").drop("file", "details").collect()) == sorted(plain)


def test_columns_of_lines_come_from_all_of_them(spark, tmp_path):
    lines = [{"data": [{"symbol": "A", "x": 1}]}, {"symbol": "B", "y": 2, "timestamp": "t"}, {"meta": {}}]
    with open(f"{tmp_path}/a.json", "w") as file:
        file.write("\n".join(map(json.dumps, lines)) + "\n\n{ no\n")
    row = file_gate.file_columns(spark, str(tmp_path), multi_line=False).first()
    assert (row.documents, row.broken_documents, set(row.columns)) == (4, 1, {"symbol", "x", "y", "timestamp"})
    assert row.columns[0] == "symbol" and not set(row.columns) & set(RAW_COLUMNS[2:])
