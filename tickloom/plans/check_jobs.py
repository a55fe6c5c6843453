"""Queries that run the jobs and the stream end to end and read what they wrote."""

from __future__ import annotations

import io
from contextlib import redirect_stdout
from datetime import datetime

from pyspark.sql import functions as F

from tickloom.plans import landing
from tickloom.plans.derived import event_bars
from tickloom.plans.jobs import JobConfig, curate, main, transform_directory, validate_and_load
from tickloom.plans.oracle import EVENT_BARS, RAW_LIST, fact
from tickloom.plans.registry import checked
from tickloom.schema import FACT_COLUMNS, RAW_COLUMNS
from tickloom.session import scratch_path
from tickloom.sinks.versioned import open_table
from tickloom.streaming.ingest import ingest_new_files

RUN_DATE = "2024-01-31"
RUN_TIME = datetime(2024, 2, 1)
EVENT_FACT = f"{EVENT_BARS}, {fact('event_bars')}"


@checked("e1_curate", f"WITH {EVENT_FACT} SELECT * FROM fact")
def curate_job(spark, sf_dir):
    source = landing.land_envelopes(event_bars(spark, sf_dir), RUN_DATE)
    config = JobConfig(source, scratch_path(spark, "target"), RUN_DATE, multi_line=False)
    summary = curate(spark, config, RUN_TIME)
    return open_table(spark, summary["processed_path"]).read().select(FACT_COLUMNS)


@checked("e2_transform_directory", f"WITH {EVENT_FACT} SELECT * FROM fact")
def transform_job(spark, sf_dir):
    source = landing.land_envelopes(event_bars(spark, sf_dir), RUN_DATE)
    target = scratch_path(spark, "target")
    transform_directory(spark, source, target, run_time=RUN_TIME, multi_line=False)
    return spark.read.parquet(target).select(FACT_COLUMNS)


@checked(
    "e3_validate_and_load",
    f"WITH {EVENT_FACT} SELECT price_id, symbol, trade_date, close_price, volume, year, month FROM fact",
)
def load_job(spark, sf_dir):
    """Every listed file passes all 17 rules, and the curated rows arrive in the warehouse table."""
    source = landing.land_envelopes(event_bars(spark, sf_dir), RUN_DATE)
    target = scratch_path(spark, "target")
    table = f"{target}/warehouse"
    config = JobConfig(source, target, RUN_DATE, multi_line=False)
    validate_and_load(spark, config, table, f"{target}/audit", run_time=RUN_TIME)
    rows = open_table(spark, table).read().withColumn("close_price", F.col("close_price").cast("double"))
    return rows.select("price_id", "symbol", "trade_date", "close_price", "volume", "year", "month")


@checked("e1_daily_increments", f"WITH {EVENT_FACT} SELECT * FROM fact")
def daily_increments(spark, sf_dir):
    """Three runs, the middle of the month last: windows continue from stored rows, and later ones are renewed."""
    bars = event_bars(spark, sf_dir)
    target = scratch_path(spark, "target")
    source = scratch_path(spark, "landed")
    parts = {"2024-01-12": "timestamp < '2024-01-12'", "2024-01-30": "timestamp >= '2024-01-20'", RUN_DATE: "timestamp BETWEEN '2024-01-12' AND '2024-01-19'"}
    for run_date, part in parts.items():
        landing.land_envelopes(bars.filter(part), run_date, source)
        summary = curate(spark, JobConfig(source, target, run_date, multi_line=False), RUN_TIME)
    return open_table(spark, summary["processed_path"]).read().select(FACT_COLUMNS)


@checked("x1_incremental_ingest", f"WITH {EVENT_BARS} SELECT {RAW_LIST} FROM event_bars")
def incremental_ingest(spark, sf_dir):
    """Two daily runs that overlap, each read once; the later files correct the earlier."""
    bars = event_bars(spark, sf_dir)
    base = scratch_path(spark, "stream")
    earlier = bars.filter("timestamp < '2024-01-20'").withColumn("volume", F.col("volume") + 1000)
    for run_date, rows in (("2024-01-30", earlier), (RUN_DATE, bars)):
        landing.land_envelopes(rows, run_date, base)
        progress = f"{base}-progress"
        ingest_new_files(spark, base, f"{base}-table", progress, multi_line=False).awaitTermination()
    return open_table(spark, f"{base}-table").read().select(RAW_COLUMNS)


@checked("x1_late_older_files", f"WITH {EVENT_BARS} SELECT {RAW_LIST} FROM event_bars")
def late_older_files(spark, sf_dir):
    """The files of an earlier date arrive after those that correct them, and change nothing."""
    bars = event_bars(spark, sf_dir)
    base = scratch_path(spark, "stream")
    earlier = bars.filter("timestamp < '2024-01-20'").withColumn("volume", F.col("volume") + 1000)
    for run_date, rows in ((RUN_DATE, bars), ("2024-01-30", earlier)):
        landing.land_envelopes(rows, run_date, base)
        ingest_new_files(spark, base, f"{base}-table", f"{base}-progress", multi_line=False).awaitTermination()
    return open_table(spark, f"{base}-table").read().select(RAW_COLUMNS)


@checked("e4_command_line", f"WITH {EVENT_FACT} SELECT * EXCLUDE (processing_timestamp) FROM fact")
def command_line(spark, sf_dir):
    """The job as its command line starts it: arguments in, snapshot and curated layer out."""
    source = landing.land_envelopes(event_bars(spark, sf_dir), RUN_DATE)
    target = scratch_path(spark, "target")
    arguments = ["--source-path", source, "--target-path", target, "--execution-date", RUN_DATE, "--json-lines"]
    with redirect_stdout(io.StringIO()):
        if main([*arguments, "--enable-skew-handling", "true", "--salt-buckets", "4"]) != 0:
            raise RuntimeError("the job failed")
    return open_table(spark, f"{target}/processed").read().select(FACT_COLUMNS).drop("processing_timestamp")
