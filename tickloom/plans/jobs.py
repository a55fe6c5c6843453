"""The end-to-end jobs: curate one execution date, and validate, curate, load and verify it."""

from __future__ import annotations

import argparse
import math
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tickloom.functions.indicators import with_indicators
from tickloom.operators import incremental, quality, reports, skew
from tickloom.operators.cleanse import cleanse
from tickloom.operators.enrich import (
    BAR_SERIES,
    INDICATOR_DEPTH,
    finish,
    standardise_dates,
)
from tickloom.operators.file_gate import evaluate_files
from tickloom.operators.long_series import ROWS_PER_BLOCK, cut_long_series
from tickloom.schema import to_warehouse_types
from tickloom.session import job_session, partitions_for, store, stored_bytes
from tickloom.sinks import curated, warehouse
from tickloom.sinks.versioned import VersionedTable
from tickloom.sources.files import read_snapshot, require_output
from tickloom.sources.json_bars import date_path, read_date_partition, scan_directory


SMALLEST_BLOCK = 100_000
SHUFFLES = "spark.sql.shuffle.partitions"
FIRST_SHUFFLES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@dataclass(frozen=True)
class JobConfig:
    source_path: str
    target_path: str
    execution_date: str
    prefix: str = "stock_data"
    multi_line: bool = True
    partition_by: tuple[str, ...] = curated.PARTITION_COLUMNS
    enable_skew_handling: bool = True
    salt_buckets: int = skew.SALT_BUCKETS
    rows_per_block: int = ROWS_PER_BLOCK
    # A run brings some days of a month; the others stay unless the run replaces whole partitions.
    merge: bool = True
    export_csv: bool = False
    # Files of the snapshot and of the export; None: by the size of the input.
    output_files: int | None = None
    # A trade date that must have rows once the warehouse is loaded.
    require_date: str | None = None


def fact_rows(
    cleansed: DataFrame,
    run_time: datetime,
    cut_long: bool = True,
    rows_per_block: int = ROWS_PER_BLOCK,
    around: DataFrame | None = None,
) -> DataFrame:
    """Stored cleansed bars to fact rows; series too long for one task are cut into blocks.

    With the stored rows ``around`` them their windows are those of the whole series; the
    result then holds these rows too, and the role of each.
    """
    dated, keep = standardise_dates(cleansed), ()
    if around is not None:
        dated, keep = incremental.together(dated, around), (incremental.ROLE,)
    if not cut_long:
        return finish(with_indicators(dated, BAR_SERIES), run_time, keep=keep)
    blocked = cut_long_series(dated, BAR_SERIES, INDICATOR_DEPTH, rows_per_block=rows_per_block)
    return finish(blocked.apply(with_indicators), run_time, keep=keep)


def curate(spark: SparkSession, config: JobConfig, run_time: datetime | None = None) -> dict | None:
    """Read, cleanse, enrich, and write the snapshot and the curated layer, a versioned table.

    Windows continue from the rows that earlier runs stored, so daily runs give what one run over
    all days gives; stored rows after late bars get their indicators anew.

    Shuffles get as many partitions as the input's size asks for.

    Returns the run's counts, or None without writing anything if there was no input.
    Everything downstream of the cleansed rows reads them from storage, and the curated
    layer is written from the stored snapshot: no step is computed twice.
    """
    try:
        with _sized_shuffles(spark, config) as size:
            raw = _raw_bars(spark, config)
            return _curate(spark, raw, config, run_time or datetime.now(), size)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@contextmanager
def _sized_shuffles(spark: SparkSession, config: JobConfig) -> Iterator[int]:
    """Shuffle partitions by the size of the input, as long as the job runs; gives that size."""
    path = date_path(config.source_path, config.execution_date, config.prefix)
    size = stored_bytes(spark, path)
    wanted = partitions_for(spark, size)
    before = {name: spark.conf.get(name, None) for name in (SHUFFLES, FIRST_SHUFFLES)}
    spark.conf.set(SHUFFLES, wanted)
    spark.conf.set(FIRST_SHUFFLES, max(wanted, int(before[FIRST_SHUFFLES] or 0)))
    try:
        yield size
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _raw_bars(spark: SparkSession, config: JobConfig) -> DataFrame:
    return read_date_partition(
        spark, config.source_path, config.execution_date, config.prefix, config.multi_line
    )


def _curate(spark, raw, config, run_time, size):
    files = config.output_files or curated.files_for(size)
    read, kept, made = Observation("read"), Observation("cleansed"), Observation("enriched")
    rows = F.count(F.lit(1)).alias("rows")
    cleansed = store(cleanse(raw.observe(read, rows)).observe(kept, rows), "cleansed")
    if read.get["rows"] == 0:
        return None
    verdict = (
        skew.skew_verdict(cleansed).first().asDict() if config.enable_skew_handling else None
    )
    block_rows = _block_rows(config, verdict)
    has_long_series = verdict is not None and verdict["max_records"] > block_rows
    processed = VersionedTable(spark, f"{config.target_path}/processed", config.partition_by)
    tail = VersionedTable(spark, f"{config.target_path}/tail", ())
    around = _around(processed, tail, standardise_dates(cleansed)) if config.merge else None
    fact = fact_rows(cleansed, run_time, has_long_series, block_rows, around)
    if around is None:
        fresh, staging = fact, None
    else:
        enriched = store(fact, "enriched")
        role = F.col(incremental.ROLE)
        fresh = enriched.filter(role == incremental.INCOMING).drop(incremental.ROLE)
        staging = enriched.filter(role != incremental.LEAD).drop(incremental.ROLE)
    snapshot_path = curated.write_snapshot(
        fresh.observe(made, rows), config.target_path, config.execution_date, files
    )
    snapshot = spark.read.schema(fresh.schema).parquet(snapshot_path)
    staging = snapshot if staging is None else staging
    current = _tail_is_current(processed, tail)
    if config.merge:
        processed.upsert(staging, fixed_partition=_keys_fix(config.partition_by))
    else:
        processed.replace_partitions(snapshot)
    # Replaced partitions may have lost rows of the tail, which then comes from the whole table.
    added = staging if config.merge and (current or processed.version == 1) else processed.read()
    newest = incremental.merge_tails(tail.read() if config.merge and current else None, added)
    tail.replace_all(newest, _tail_of(processed))
    if config.export_csv:
        curated.write_csv(snapshot, f"{config.target_path}/export/date={config.execution_date}", files)
    return {
        "rows_read": read.get["rows"],
        "rows_cleansed": kept.get["rows"],
        "rows_enriched": made.get["rows"],
        "skew": verdict,
        "snapshot_path": snapshot_path,
        "processed_path": processed.path,
    }


def _keys_fix(partition_by: tuple[str, ...]) -> bool:
    """Whether the key of a fact row, its symbol and date, determines its partition."""
    return set(partition_by) <= {"symbol", "trade_date", "year", "quarter", "month", "day", "day_of_week"}


def _tail_of(processed: VersionedTable) -> str:
    return f"tail of version {processed.version}"


def _tail_is_current(processed: VersionedTable, tail: VersionedTable) -> bool:
    """A run that ended between the table's commit and the tail's leaves a tail of an older version."""
    return processed.exists and tail.exists and tail.state["operation"] == _tail_of(processed)


def _around(processed: VersionedTable, tail: VersionedTable, incoming: DataFrame) -> DataFrame | None:
    if not processed.exists:
        return None
    ends = tail.read() if _tail_is_current(processed, tail) else None
    return incremental.context(incoming, processed.read(), ends)


def _block_rows(config: JobConfig, verdict: dict | None) -> int:
    """How many rows a symbol may have before it is cut.

    Of skewed data the largest symbol is cut into about ``salt_buckets`` blocks, unless
    these would be too small to be worth it.
    """
    if not verdict or not verdict["is_skewed"]:
        return config.rows_per_block
    share = math.ceil(verdict["max_records"] / config.salt_buckets)
    return min(config.rows_per_block, max(share, SMALLEST_BLOCK))


def transform_directory(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    partition_by: tuple[str, ...] = (),
    export_csv: bool = False,
    run_time: datetime | None = None,
    multi_line: bool = True,
) -> dict:
    """Transform all JSON files of a folder; returns statistics and the newest daily rollup."""
    cleansed = store(cleanse(scan_directory(spark, source_path, multi_line=multi_line)), "cleansed")
    fact = store(fact_rows(cleansed, run_time or datetime.now()), "fact")
    curated.write_curated(fact, target_path, partition_by)
    if export_csv:
        files = curated.files_for(stored_bytes(spark, source_path))
        curated.write_csv(fact, f"{target_path.rstrip('/')}_csv", files)
    return {
        **reports.dataset_stats(fact).first().asDict(),
        "rollup": [r.asDict() for r in reports.daily_rollup(fact, 10).collect()],
    }


def validate_and_load(
    spark: SparkSession,
    config: JobConfig,
    table_path: str,
    audit_path: str,
    suite: quality.Suite = quality.FULL_SUITE,
    max_failed_ratio: float = 0.0,
    run_time: datetime | None = None,
) -> dict:
    """Validate every listed file, stop if the gate fails, else curate, load and verify."""
    with _sized_shuffles(spark, config) as size:
        return _validate_and_load(spark, config, table_path, audit_path, suite, max_failed_ratio, run_time, size)


def _validate_and_load(spark, config, table_path, audit_path, suite, max_failed_ratio, run_time, size):
    raw = store(_raw_bars(spark, config), "raw")
    path = date_path(config.source_path, config.execution_date, config.prefix)
    results = store(evaluate_files(spark, path, suite, raw, multi_line=config.multi_line), "validation")
    curated.write_audit(results, audit_path, config.execution_date)
    checked = quality.gate(results, max_failed_ratio)

    summary = _curate(spark, raw, config, run_time or datetime.now(), size)
    if summary is None:
        raise warehouse.LoadError(f"no bars for {config.execution_date}")
    snapshot = read_snapshot(spark, config.target_path, config.execution_date)
    output = require_output(snapshot)
    table = VersionedTable(spark, table_path, config.partition_by)
    table.upsert(to_warehouse_types(snapshot), fixed_partition=_keys_fix(config.partition_by))
    verified = verify_load(table.read(), snapshot, config.partition_by)
    require_dates(table.read(), snapshot)
    if config.require_date:
        require_date(table.read(), config.require_date)
    return {**checked, **summary, **output, **verified}


def verify_load(
    table: DataFrame, staged: DataFrame, partition_by: tuple[str, ...] = curated.PARTITION_COLUMNS
) -> dict:
    """Every loaded key must be in the table; raises otherwise."""
    loaded = warehouse.touched(table, staged, partition_by).select("price_id")
    missing = staged.join(loaded, "price_id", "left_anti").limit(5).collect()
    if missing:
        raise warehouse.LoadError(f"not loaded: {[r['price_id'] for r in missing]}")
    return {"table_rows": table.count()}


def require_dates(table: DataFrame, staged: DataFrame) -> None:
    """Every trade date of the staged rows must have at least as many rows in the table."""
    wanted = staged.groupBy("trade_date").agg(F.count("*").alias("staged"))
    loaded = table.join(wanted, "trade_date", "left_semi").groupBy("trade_date").agg(F.count("*").alias("loaded"))
    short = wanted.join(loaded, "trade_date", "left").filter(F.coalesce("loaded", F.lit(0)) < F.col("staged")).limit(5).collect()
    if short:
        raise warehouse.LoadError(f"dates with too few rows: {[str(r['trade_date']) for r in short]}")


def require_date(table: DataFrame, trade_date: str) -> int:
    """Rows of a trade date in the table; raises if there are none."""
    rows = reports.row_count(table, trade_date).first()["cnt"]
    if rows == 0:
        raise warehouse.LoadError(f"the table has no rows for {trade_date}")
    return rows


def parse_arguments(arguments: list[str]) -> JobConfig:
    parser = argparse.ArgumentParser(description="Curate one execution date of market bars.")
    parser.add_argument("--source-path", required=True)
    parser.add_argument("--target-path", required=True)
    parser.add_argument("--execution-date", default=date.today().isoformat())
    parser.add_argument("--prefix", default=JobConfig.prefix)
    parser.add_argument(
        "--json-lines", dest="multi_line", action="store_false", help="one document per line, not per file"
    )
    parser.add_argument(
        "--enable-skew-handling", type=lambda v: v.lower() == "true", default=True, metavar="true|false"
    )
    parser.add_argument("--salt-buckets", type=int, default=JobConfig.salt_buckets)
    parser.add_argument("--rows-per-block", type=int, default=JobConfig.rows_per_block)
    parser.add_argument("--replace-partitions", action="store_false", dest="merge")
    parser.add_argument("--export-csv", action="store_true")
    parser.add_argument("--require-date", help="a trade date that must have rows after a load")
    return JobConfig(**vars(parser.parse_args(arguments)))


def main(arguments: list[str] | None = None) -> int:
    config = parse_arguments(sys.argv[1:] if arguments is None else arguments)
    spark = job_session("curate market bars")
    summary = curate(spark, config)
    print(summary or f"no bars found for {config.execution_date}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
