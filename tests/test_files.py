import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions.indicators import DAILY
from tickloom.operators.cleanse import cleanse
from tickloom.operators.enrich import enrich
from tickloom.operators.quality import QualityGateError
from tickloom.plans.jobs import JobConfig, curate, main, parse_arguments, require_date, transform_directory, validate_and_load
from tickloom.schema import FACT_COLUMNS, RAW_COLUMNS, WAREHOUSE_SCHEMA, decimal_overflows, to_warehouse_types
from tickloom.sinks import curated, warehouse
from tickloom.sinks.versioned import open_table
from tickloom.sources import files, json_bars, payloads
from tickloom.streaming.ingest import ingest_new_files
from tests.conftest import RAW_ROW


def write(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(content if isinstance(content, str) else json.dumps(content, indent=1))


def bars(symbol, days, **changes):
    return [{**RAW_ROW, "symbol": symbol, "timestamp": f"2024-01-{d:02}", **changes} for d in days]


def envelope(symbol, days, **changes):
    return {"meta": {"symbol": symbol}, "data": bars(symbol, days, **changes)}


@pytest.fixture
def landed(tmp_path):
    """Two symbols of one execution date, which is not the date of their bars."""
    base = f"{tmp_path}/raw"
    for s in ("AAPL", "MSFT"):
        write(f"{base}/stock_data/date=2024-01-31/symbol={s}/{s}.json", envelope(s, range(2, 12)))
    return base


def test_three_shapes_and_an_unreadable_file(spark, tmp_path):
    write(f"{tmp_path}/a/env.json", envelope("AAPL", [2, 3]))
    write(f"{tmp_path}/b/c/list.json", bars("MSFT", [2, 3, 4]))
    write(f"{tmp_path}/one.json", bars("TSLA", [2])[0])
    write(f"{tmp_path}/broken.json", "{ no json")
    write(f"{tmp_path}/readme.txt", "not looked at")
    rows = json_bars.scan_directory(spark, str(tmp_path))
    assert {r["symbol"]: r["n"] for r in rows.groupBy("symbol").agg(F.count("*").alias("n")).collect()} == {
        "AAPL": 2, "MSFT": 3, "TSLA": 1,
    }
    assert rows.columns == [*RAW_COLUMNS, "source_file"]
    unreadable = json_bars.unreadable_documents(json_bars.read_documents(spark, str(tmp_path)))
    assert [r["source_file"].rsplit("/", 1)[1] for r in unreadable.collect()] == ["broken.json"]


def test_nothing_readable_is_an_error(spark, tmp_path):
    write(f"{tmp_path}/broken.json", "{ no json")
    with pytest.raises(ValueError):
        json_bars.scan_directory(spark, str(tmp_path))


def test_one_bad_number_costs_one_value(spark, tmp_path):
    write(f"{tmp_path}/a.json", envelope("AAPL", [2], volume="many", open_price="10.25"))
    row = json_bars.read_bars(spark, str(tmp_path)).first()
    assert row["volume"] is None and row["open_price"] == 10.25 and row["close_price"] == 11.0
    text = json_bars.text_bars(json_bars.read_documents(spark, str(tmp_path)))
    rejects = json_bars.latest_load_errors(json_bars.rejected_values(text, F.current_timestamp())).collect()
    assert [(r["column_name"], r["raw_value"], r["reason"]) for r in rejects] == [("volume", "many", "not a bigint")]


def test_folder_names_do_not_override_records(spark, landed):
    rows = json_bars.read_date_partition(spark, landed, "2024-01-31")
    assert rows.count() == 20 and {r["timestamp"] for r in rows.collect()} == {f"2024-01-{d:02}" for d in range(2, 12)}


@pytest.mark.parametrize("name", ["b.json", "b.csv", "b.parquet", "j.dat", "c.dat"])
def test_read_by_extension(spark, raw, tmp_path, name):
    path = f"{tmp_path}/{name}"
    if name in ("b.json", "j.dat"):
        write(path, envelope("AAPL", [2, 3]))
    elif name.endswith("parquet"):
        raw({}, {}).write.parquet(path)
    else:
        write(path, ",".join(RAW_COLUMNS) + "\n" + "AAPL,2024-01-02,1,2,1,1.5,1.5,100,0,1\n" * 2)
    rows = files.read_by_extension(spark, path)
    assert rows.count() == 2 and dict(rows.dtypes)["volume"] == "bigint"


def test_payloads(spark, tmp_path):
    day = {f"{i}. {k}": v for i, (k, v) in enumerate(
        [("open", "1.0"), ("high", "2.0"), ("low", "0.5"), ("close", "1.5"), ("adjusted close", "1.4"),
         ("volume", "100"), ("dividend amount", "0.0"), ("split coefficient", "1.0")], 1)}
    write(f"{tmp_path}/daily/a.json", {
        "Meta Data": {"2. Symbol": "ibm", "3. Last Refreshed": "2024-01-03"},
        "Time Series (Daily)": {"2024-01-02": day, "2024-01-03": {**day, "4. close": "oops"}},
    })
    rows = payloads.read_daily(spark, f"{tmp_path}/daily").orderBy("timestamp").collect()
    assert [(r["symbol"], r["close_price"], r["volume"]) for r in rows] == [("IBM", 1.5, 100), ("IBM", None, 100)]
    meta = payloads.read_daily_meta(spark, f"{tmp_path}/daily").first()
    assert (meta["output_size"], meta["time_zone"]) == ("unknown", "US/Eastern")

    write(f"{tmp_path}/quote/a.json", {"Global Quote": {"01. symbol": "IBM", "05. price": "7.5"}})
    write(f"{tmp_path}/quote/b.json", {"Global Quote": {}})
    (quote,) = payloads.read_quotes(spark, f"{tmp_path}/quote").collect()
    assert (quote["price"], quote["volume"], quote["change_percent"], quote["latest_trading_day"]) == (7.5, 0, "0%", "")

    write(f"{tmp_path}/intra/a.json", {
        "Meta Data": {"2. Symbol": "IBM"},
        "Time Series (5min)": {"2024-01-02 10:00:00": {"1. open": "1", "4. close": "2", "5. volume": "3"}},
    })
    row = payloads.read_intraday(spark, f"{tmp_path}/intra").first()
    assert (row["timestamp"], row["close_price"], row["volume"]) == ("2024-01-02 10:00:00", 2.0, 3)
    with pytest.raises(ValueError):
        payloads.read_intraday(spark, f"{tmp_path}/intra", "2min")

    write(f"{tmp_path}/co/a.json", {"Symbol": "IBM", "Name": "Big", "MarketCapitalization": "123", "Other": {"x": 1}})
    write(f"{tmp_path}/co/b.json", {"Note": "no data"})
    (company,) = payloads.read_overviews(spark, f"{tmp_path}/co").collect()
    assert (company["company_name"], company["market_cap"]) == ("Big", 123)


def test_curate_writes_once_and_can_be_repeated(spark, landed, tmp_path):
    config = JobConfig(landed, f"{tmp_path}/out", "2024-01-31", export_csv=True)
    for _ in range(2):
        summary = curate(spark, config, datetime(2024, 2, 1))
    assert (summary["rows_read"], summary["rows_cleansed"], summary["rows_enriched"]) == (20, 20, 20)
    processed = open_table(spark, f"{tmp_path}/out/processed").read()
    assert processed.count() == 20 and set(processed.columns) == set(FACT_COLUMNS)
    assert files.read_snapshot(spark, f"{tmp_path}/out", "2024-01-31").count() == 20
    assert files.output_summary(files.read_snapshot(spark, f"{tmp_path}/out", "2024-01-31")).first()["files"] == 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/export/date=2024-01-31").count() == 20


def test_curate_keeps_other_months(spark, landed, tmp_path):
    write(f"{landed}/stock_data/date=2024-02-29/a.json", [{**RAW_ROW, "timestamp": "2024-02-05"}])
    for day in ("2024-01-31", "2024-02-29"):
        curate(spark, JobConfig(landed, f"{tmp_path}/out", day))
    months = open_table(spark, f"{tmp_path}/out/processed").read().groupBy("month").count()
    assert {r["month"]: r["count"] for r in months.collect()} == {1: 20, 2: 1}


def test_curate_merges_into_a_month(spark, landed, tmp_path):
    write(f"{landed}/stock_data/date=2024-02-01/a.json", [{**RAW_ROW, "timestamp": "2024-01-31"}])
    for day in ("2024-01-31", "2024-02-01"):
        curate(spark, JobConfig(landed, f"{tmp_path}/out", day, merge=True))
    assert open_table(spark, f"{tmp_path}/out/processed").read().count() == 21


def test_curate_without_input_writes_nothing(spark, landed, tmp_path):
    assert curate(spark, JobConfig(landed, f"{tmp_path}/out", "2030-01-01")) is None
    write(f"{landed}/stock_data/date=2030-01-02/a.json", {"meta": {}, "data": []})
    assert curate(spark, JobConfig(landed, f"{tmp_path}/out", "2030-01-02")) is None
    assert not os.path.exists(f"{tmp_path}/out")


def test_curate_with_long_series(spark, landed, tmp_path):
    now = datetime(2024, 2, 1)
    curate(spark, JobConfig(landed, f"{tmp_path}/a", "2024-01-31"), now)
    curate(spark, JobConfig(landed, f"{tmp_path}/b", "2024-01-31", rows_per_block=3), now)
    a, b = (open_table(spark, f"{tmp_path}/{n}/processed").read() for n in "ab")
    assert a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_transform_directory(spark, landed, tmp_path):
    summary = transform_directory(spark, landed, f"{tmp_path}/fact", ("symbol",), export_csv=True)
    assert (summary["total_records"], summary["unique_symbols"]) == (20, 2) and len(summary["rollup"]) == 10
    assert sorted(d for d in os.listdir(f"{tmp_path}/fact") if "=" in d) == ["symbol=AAPL", "symbol=MSFT"]


def test_gate_blocks_the_load(spark, landed, tmp_path):
    config = JobConfig(landed, f"{tmp_path}/out", "2024-01-31")
    paths = f"{tmp_path}/fact", f"{tmp_path}/audit"
    done = validate_and_load(spark, config, *paths)
    assert done["table_rows"] == 20 and done["evaluated"] == 34
    assert require_date(open_table(spark, paths[0]).read(), "2024-01-05") == 2
    with pytest.raises(warehouse.LoadError):
        require_date(open_table(spark, paths[0]).read(), "2024-03-05")
    write(f"{landed}/stock_data/date=2024-02-02/bad.json", envelope("AAPL", [2], close_price=None))
    with pytest.raises(QualityGateError, match="close_price"):
        validate_and_load(spark, JobConfig(landed, f"{tmp_path}/out", "2024-02-02"), *paths)
    assert not os.path.exists(f"{tmp_path}/out/daily_snapshots/date=2024-02-02")
    assert spark.read.json(paths[1]).filter("NOT success").count() == 1


def test_arguments():
    config = parse_arguments(["--source-path", "s", "--target-path", "t", "--enable-skew-handling", "false"])
    assert (config.source_path, config.enable_skew_handling, config.salt_buckets) == ("s", False, 10)
    assert len(config.execution_date) == 10
    with pytest.raises(SystemExit):
        parse_arguments(["--source-path", "s"])


def keyed(spark, rows):
    df = spark.createDataFrame(rows, "price_id string, trade_date string, volume long")
    day = F.to_date("trade_date")
    return df.withColumns({"trade_date": day, "year": F.year(day), "month": F.month(day)})


def volumes(df):
    return {r["price_id"]: r["volume"] for r in df.collect()}


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    warehouse.append(keyed(spark, [("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", "2024-02-01", 1)]), path)
    before = os.listdir(f"{path}/year=2024/month=2")
    table = warehouse.upsert(keyed(spark, [("b", "2024-01-02", 2), ("d", "2024-01-03", 2)]), path)
    assert volumes(table) == {"a": 1, "b": 2, "c": 1, "d": 2}
    assert os.listdir(f"{path}/year=2024/month=2") == before
    with pytest.raises(warehouse.LoadError):
        warehouse.upsert(keyed(spark, [("e", "2024-01-02", 2)] * 2), path)


def test_upsert_into_a_new_and_an_unpartitioned_table(spark, tmp_path):
    rows = keyed(spark, [("a", "2024-01-01", 1), ("b", "2024-01-02", 1)])
    path = f"{tmp_path}/t"
    assert warehouse.upsert(rows, path, partition_by=()).count() == 2
    table = warehouse.upsert(keyed(spark, [("a", "2024-01-01", 5)]), path, partition_by=())
    assert volumes(table) == {"a": 5, "b": 1}


def test_replace_date(spark, tmp_path):
    path = f"{tmp_path}/t"
    warehouse.append(keyed(spark, [("a", "2024-01-01", 1), ("b", "2024-01-02", 1)]), path)
    table = warehouse.replace_date(keyed(spark, [("x", "2024-01-02", 9)]), path, "2024-01-02")
    assert volumes(table) == {"a": 1, "x": 9}
    for rows in ([("y", "2024-01-03", 9)], []):
        with pytest.raises(warehouse.LoadError):
            warehouse.replace_date(keyed(spark, rows), path, "2024-01-02")


def test_insert_if_absent(spark, tmp_path):
    path = f"{tmp_path}/t"
    warehouse.append(keyed(spark, [("a", "2024-01-01", 1)]), path)
    new = keyed(spark, [("a", "2024-01-01", 2), ("b", "2024-01-01", 3), ("b", "2024-01-01", 3)])
    assert warehouse.insert_if_absent(new, path, ("price_id",)) == 2
    assert volumes(spark.read.parquet(path)) == {"a": 1, "b": 3}


def test_declared_table_sees_what_was_upserted(spark, raw, tmp_path):
    fact = to_warehouse_types(enrich(cleanse(raw({}, {"timestamp": "2024-02-05"}))))
    assert fact.schema.simpleString() == WAREHOUSE_SCHEMA.simpleString()
    path = f"{tmp_path}/fact"
    warehouse.create_table(spark, "declared_bars", path)
    assert spark.table("declared_bars").count() == 0
    warehouse.upsert(fact, path)
    warehouse.refresh_partitions(spark, "declared_bars")
    assert {str(r["close_price"]) for r in spark.table("declared_bars").collect()} == {"11.0000"}
    assert spark.table("declared_bars").filter("year = 2024 AND month = 2").count() == 1


def test_percentages_too_large_for_their_decimals_are_counted(spark):
    df = spark.createDataFrame([(1e9, 1.0), (5.0, None)], "daily_return double, sma_5 double")
    assert decimal_overflows(df).first().asDict() == {"sma_5": 0, "daily_return": 1}
    assert [r["daily_return"] for r in to_warehouse_types(df).collect()][0] is None


def test_bucketed_table_spares_the_shuffle(spark, tmp_path, closes):
    warehouse.save_bucketed(closes([1.0, 2.0, 4.0]), "bucketed_bars", f"{tmp_path}/b", 4)
    lagged = spark.table("bucketed_bars").withColumn("p", F.lag("close_price").over(DAILY.ordered()))
    assert "Exchange" not in lagged._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["p"] or 0 for r in lagged.collect()) == [0, 1.0, 2.0]


def test_json_paths_of_a_load(spark, tmp_path):
    write(f"{tmp_path}/a.json", '{"s": "A", "bar": {"c": 1.5}}\n{"s": "B"}\n')
    rows = files.read_for_load(spark, f"{tmp_path}/a.json", "JSON", json_paths={"symbol": "$.s", "close": "$.bar.c"})
    assert [tuple(r) for r in rows.orderBy("symbol").collect()] == [("A", "1.5"), ("B", None)]
    with pytest.raises(ValueError):
        files.read_for_load(spark, f"{tmp_path}/a.json", "ORC")


def test_statistics_reach_the_optimizer(spark, tmp_path):
    path = f"{tmp_path}/t"
    warehouse.append(keyed(spark, [("a", "2024-01-01", 1), ("b", "2024-01-01", 1)]), path, ())
    warehouse.register(spark, "analyzed_bars", path)
    warehouse.analyze(spark, "analyzed_bars")
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        stats = spark.table("analyzed_bars")._jdf.queryExecution().optimizedPlan().stats()
        assert stats.rowCount().get() == 2
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")


def test_files_of_a_snapshot_and_an_export(spark, tmp_path):
    rows = spark.range(1000).withColumn("name", F.concat(F.lit('a, "b" '), "id"))
    for wanted in (4, 1):
        snapshot = spark.read.parquet(curated.write_snapshot(rows, str(tmp_path), "2024-01-01", files=wanted))
        assert files.output_summary(snapshot).first()["files"] == wanted
        assert snapshot.orderBy("id").collect() == rows.collect()
        curated.write_csv(rows, f"{tmp_path}/csv", files=wanted)
        back = spark.read.option("header", True).option("escape", "\\").csv(f"{tmp_path}/csv")
        assert files.output_summary(back).first()["files"] == wanted
        assert {(int(r["id"]), r["name"]) for r in back.collect()} == {tuple(r) for r in rows.collect()}
    none = spark.read.parquet(curated.write_snapshot(rows.limit(0), str(tmp_path), "2024-01-02"))
    assert none.columns == ["id", "name"] and none.isEmpty()
    assert [curated.files_for(n, 10) for n in (0, 1, 10, 11, 100)] == [1, 1, 1, 2, 10]


def test_stream_reads_each_file_once_and_repeats_safely(spark, landed, tmp_path):
    table, progress = f"{tmp_path}/bars", f"{tmp_path}/progress"

    def run(checkpoint=progress):
        query = ingest_new_files(spark, landed, table, checkpoint, files_per_batch=1)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    assert run() == 2
    assert open_table(spark, table).read().count() == 20
    assert run() == 0
    write(f"{landed}/stock_data/date=2024-02-01/symbol=AAPL/a.json", envelope("AAPL", [11, 12], volume=7))
    assert run() == 1
    assert open_table(spark, table).read().count() == 21
    # All files once more, as after a lost checkpoint: in an order of its own, but no row twice.
    run(f"{tmp_path}/again")
    assert open_table(spark, table).read().count() == 21


def test_command_line(spark, landed, tmp_path, capsys):
    assert main(["--source-path", landed, "--target-path", f"{tmp_path}/out", "--execution-date", "2024-01-31"]) == 0
    assert "rows_enriched" in capsys.readouterr().out


def test_upsert_keeps_the_null_partition_beyond_the_limit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouse, "MAX_PARTITION_LITERALS", 1)
    kind = "price_id string, part string, close_price double"
    old = spark.createDataFrame([("a", None, 1.0), ("b", "p", 2.0), ("c", "q", 3.0)], kind)
    path = f"{tmp_path}/table"
    warehouse.upsert(old, path, ["price_id"], partition_by=["part"])
    new = spark.createDataFrame([("d", None, 4.0), ("e", "p", 5.0)], kind)
    warehouse.upsert(new, path, ["price_id"], partition_by=["part"])
    assert sorted(r.price_id for r in spark.read.parquet(path).collect()) == ["a", "b", "c", "d", "e"]
    with pytest.raises(warehouse.LoadError):
        warehouse.upsert(new.drop("close_price"), path, ["price_id"], partition_by=["part"])


def test_the_newest_file_of_a_batch_wins(spark):
    from tickloom.streaming.ingest import newest_bars

    rows = [("X", "2024-01-01", 11.0, "/raw/date=2024-01-01/a.json"), (" x", "2024-01-01", 12.0, "/raw/date=2024-01-02/a.json")]
    frame = spark.createDataFrame(rows, "symbol string, timestamp string, close_price double, source_file string")
    assert [r.close_price for r in newest_bars(frame).collect()] == [12.0]


def test_the_task_of_a_single_snapshot_file_reads_no_shuffle(spark, tmp_path):
    import glob

    from tickloom.session import shared_folder

    rows = spark.range(1000, numPartitions=4).groupBy((F.col("id") % 100).alias("id")).agg(F.count("*").alias("rows"))
    spark.sparkContext.setJobGroup("one-file", "")
    try:
        path = curated.write_snapshot(rows, str(tmp_path), "2024-01-01")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    last = tracker.getJobInfo(max(tracker.getJobIdsForGroup("one-file")))
    assert [tracker.getStageInfo(s).numTasks for s in last.stageIds] == [1]
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(i, 10) for i in range(100)]
    assert not glob.glob(f"{shared_folder(spark).removeprefix('file://')}/snapshot-rows-*")


def test_exports_and_snapshots_have_files_by_the_size_of_the_input(spark, sf_dir, monkeypatch):
    from tickloom.plans import check_sinks, registry

    queries, _ = registry.load()
    written = []
    csv, snapshot = check_sinks.curated.write_csv, check_sinks.curated.write_snapshot
    monkeypatch.setattr(check_sinks, "FILE_BYTES", 10_000)
    monkeypatch.setattr(check_sinks.curated, "write_csv", lambda df, path, files=1: (written.append(files), csv(df, path, files)))
    monkeypatch.setattr(check_sinks.curated, "write_snapshot", lambda df, path, day, files=1: (written.append(files), snapshot(df, path, day, files))[1])
    assert queries["k5_csv_export"](spark, sf_dir).count() == 5334
    assert written[0] > 3
    queries["k11_repeated_run"](spark, sf_dir).collect()
    assert len(written) == 3 and min(written[1:]) > 1


def test_a_task_scans_and_writes_little(spark):
    from tickloom.session import JOB_SETTINGS
    from tickloom.sinks import curated

    assert JOB_SETTINGS["spark.sql.files.maxPartitionBytes"] == JOB_SETTINGS["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "32MB"
    assert curated.files_for(600 * 1024 * 1024) == 10
