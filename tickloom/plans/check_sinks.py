"""Queries over the writers and warehouse operators: write, then read the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.indicators import DAILY
from tickloom.operators import quality
from tickloom.operators.enrich import BAR_SERIES, standardise_dates
from tickloom.plans.derived import daily_fact, event_bars, event_fact, ship_bars, ship_fact, type_bars
from tickloom.plans.oracle import EVENT_BARS, RAW_LIST, SHIP_BARS, TYPE_BARS, fact
from tickloom.plans.registry import checked
from tickloom.schema import FACT_COLUMNS, WAREHOUSE_DECIMALS, to_warehouse_types
from tickloom.session import partitions_for, scratch_path, store, store_in_slices, stored_bytes
from tickloom.sinks import curated, warehouse
from tickloom.sinks.versioned import open_table
from tickloom.sources.files import file_inventory, output_summary, read_csv_bars

EVENT_FACT = f"{EVENT_BARS}, {fact('event_bars')}"
SHIP_FACT = f"{SHIP_BARS}, {fact('ship_bars')}"
RUN_DATE = "2024-01-31"
# Stored input for each file of an export or a snapshot, which one task writes.
FILE_BYTES = 128 * 1024 * 1024
# Stored input whose fact rows are appended at a time; their shuffles are some ten times as large.
SLICE_BYTES = 256 * 1024 * 1024


@checked("k1_curated_write", f"WITH {SHIP_FACT} SELECT * FROM fact")
def curated_write(spark, sf_dir):
    """Written by year and month; a second write replaces only the partitions it brings."""
    path = scratch_path(spark, "processed")
    rows = store(ship_fact(spark, sf_dir), "fact")
    curated.write_curated(rows, path)
    curated.write_curated(rows.filter("year = 1998"), path)
    return spark.read.schema(rows.schema).parquet(path).select(FACT_COLUMNS)


@checked(
    "k2_sized_files",
    f"WITH {SHIP_BARS} SELECT count(*) AS row_count, TRUE AS files_small_enough FROM ship_bars",
)
def sized_files(spark, sf_dir):
    path = scratch_path(spark, "sized")
    curated.write_sized(ship_bars(spark, sf_dir), path, rows_per_file=10_000)
    return file_inventory(spark.read.parquet(path)).agg(
        F.sum("row_count").alias("row_count"), (F.max("row_count") <= 10_000).alias("files_small_enough")
    )


@checked(
    "k3_daily_snapshot",
    f"""WITH {EVENT_FACT} SELECT files, symbol, trade_date, close_price, volume, files AS file_count
    FROM fact, (VALUES (1), (4)) f(files)""",
)
def daily_snapshot(spark, sf_dir):
    """The rows of a snapshot in one file and in four, each written over an earlier one in another number of files."""
    fact = store(event_fact(spark, sf_dir), "fact")
    together = None
    for wanted, before in ((1, 4), (4, 1)):
        target = scratch_path(spark, "target")
        curated.write_snapshot(fact, target, RUN_DATE, files=before)
        snapshot = spark.read.parquet(curated.write_snapshot(fact, target, RUN_DATE, files=wanted))
        count = output_summary(snapshot).first()["files"]
        rows = snapshot.select(
            F.lit(wanted).alias("files"), "symbol", "trade_date", "close_price", "volume", F.lit(count).cast("int").alias("file_count")
        )
        together = rows if together is None else together.unionByName(rows)
    return together


@checked(
    "k4_partitioned_write",
    f"WITH {TYPE_BARS} SELECT symbol, count(*) AS row_count FROM type_bars GROUP BY 1",
)
def partitioned_write(spark, sf_dir):
    path = scratch_path(spark, "by-symbol")
    curated.write_curated(type_bars(spark, sf_dir), path, ("symbol",))
    return spark.read.parquet(path).groupBy("symbol").agg(F.count("*").alias("row_count"))


@checked("k5_csv_export", f"WITH {SHIP_BARS} SELECT {RAW_LIST} FROM ship_bars")
def csv_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    files = max(3, curated.files_for(stored_bytes(spark, f"{sf_dir}/lineitem.parquet"), FILE_BYTES))
    curated.write_csv(ship_bars(spark, sf_dir), path, files=files)
    return read_csv_bars(spark, path)


@checked(
    "k6_audit_trail",
    f"""WITH {EVENT_BARS} SELECT CAST(count(DISTINCT symbol) * 11 AS BIGINT) AS outcomes,
    DATE '{RUN_DATE}' AS date FROM event_bars""",
)
def audit_trail(spark, sf_dir):
    """Written twice for one date: the second run replaces the first."""
    path = scratch_path(spark, "audit")
    results = store(quality.evaluate(event_bars(spark, sf_dir), quality.CORE_SUITE, by=["symbol"]), "outcomes")
    curated.write_audit(results, path, RUN_DATE)
    curated.write_audit(results, path, RUN_DATE)
    return spark.read.json(path).groupBy("date").agg(F.count("*").alias("outcomes"))


def _warehouse_columns() -> str:
    types = {c: t.simpleString() for t, columns in WAREHOUSE_DECIMALS.items() for c in columns}
    return ", ".join(
        f"CAST(TRY_CAST({c} AS {types[c]}) AS DOUBLE) AS {c}" if c in types else c for c in FACT_COLUMNS
    )


@checked("k7_warehouse_types", f"WITH {EVENT_FACT} SELECT {_warehouse_columns()} FROM fact")
def warehouse_types(spark, sf_dir):
    """Decimals of the warehouse, shown as doubles; percentages too large for theirs are NULL."""
    rows = to_warehouse_types(event_fact(spark, sf_dir))
    decimals = [c for columns in WAREHOUSE_DECIMALS.values() for c in columns]
    return rows.withColumns({c: F.col(c).cast("double") for c in decimals})


@checked(
    "k7_bucketed_table",
    f"WITH {SHIP_BARS} SELECT symbol, trade_date, lag(close_price) OVER (PARTITION BY symbol ORDER BY trade_date)"
    " AS previous_close FROM ship_bars",
)
def bucketed_table(spark, sf_dir):
    """Distributed by symbol, so that the window reads its buckets without a shuffle."""
    path = scratch_path(spark, "bucketed")
    name = "bucketed_" + path.rsplit("-", 1)[-1]
    rows = standardise_dates(ship_bars(spark, sf_dir)).select("symbol", "trade_date", "close_price")
    buckets = partitions_for(spark, stored_bytes(spark, f"{sf_dir}/lineitem.parquet"))
    warehouse.save_bucketed(rows, name, path, buckets)
    previous = F.lag("close_price").over(DAILY.ordered())
    return spark.table(name).select("symbol", "trade_date", previous.alias("previous_close"))


@checked(
    "k8_append_load",
    f"""WITH {EVENT_FACT} SELECT trade_date, 2 * count(*) AS row_count FROM fact GROUP BY 1""",
)
def append_load(spark, sf_dir):
    path = scratch_path(spark, "appended")
    rows = store(event_fact(spark, sf_dir), "fact")
    warehouse.append(rows, path)
    warehouse.append(rows, path)
    table = spark.read.schema(rows.schema).parquet(path)
    return table.groupBy("trade_date").agg(F.count("*").alias("row_count"))


UPSERTED = """SELECT price_id, trade_date, CASE WHEN {new} THEN close_price + 1 ELSE close_price END AS close_price,
  volume FROM fact WHERE {old} OR {new}"""


@checked(
    "k9_key_upsert",
    f"WITH {SHIP_FACT} "
    + UPSERTED.format(old="trade_date < DATE '1999-07-01'", new="trade_date >= DATE '1999-01-01'"),
)
def key_upsert(spark, sf_dir):
    """The first half is loaded; then rows overlapping it are merged by key, in one commit."""
    rows = store(ship_fact(spark, sf_dir), "fact")
    table = open_table(spark, scratch_path(spark, "upserted"))
    table.append(rows.filter("trade_date < DATE'1999-07-01'"))
    later = rows.filter("trade_date >= DATE'1999-01-01'")
    changed = store(later.withColumn("close_price", F.col("close_price") + 1), "staging")
    return table.upsert(changed, fixed_partition=True).read().select("price_id", "trade_date", "close_price", "volume")


@checked(
    "k9_moved_keys",
    f"""WITH {EVENT_FACT} SELECT price_id, CASE WHEN volume % 3 = 0 THEN trade_date + 40 ELSE trade_date END AS trade_date,
    CAST(month(CASE WHEN volume % 3 = 0 THEN trade_date + 40 ELSE trade_date END) AS INTEGER) AS month,
    CASE WHEN volume % 3 = 0 THEN volume + 1000 ELSE volume END AS volume FROM fact""",
)
def moved_keys(spark, sf_dir):
    """Keys whose rows come back with another date: each is found in its old partition and stored once."""
    rows = store(event_fact(spark, sf_dir).select("price_id", "symbol", "trade_date", "volume", "year", "month"), "fact")
    table = open_table(spark, scratch_path(spark, "moved")).append(rows)
    later = F.date_add("trade_date", 40)
    moved = rows.filter("volume % 3 = 0").withColumns(
        {"trade_date": later, "year": F.year(later), "month": F.month(later), "volume": F.col("volume") + 1000}
    )
    return table.upsert(store(moved, "staging")).read().select("price_id", "trade_date", "month", "volume")


@checked(
    "k9_earlier_version",
    f"""WITH {EVENT_FACT} SELECT CAST(1 AS INTEGER) AS version, price_id, volume FROM fact
    UNION ALL SELECT 2, price_id, volume + 1 FROM fact""",
)
def earlier_version(spark, sf_dir):
    """A reader of the version before an upsert still sees all its rows."""
    rows = store(event_fact(spark, sf_dir).select("price_id", "trade_date", "volume", "year", "month"), "fact")
    table = open_table(spark, scratch_path(spark, "versions")).append(rows)
    table.upsert(store(rows.withColumn("volume", F.col("volume") + 1), "staging"), fixed_partition=True)
    shown = [table.at(n).read().select(F.lit(n).alias("version"), "price_id", "volume") for n in (1, 2)]
    return shown[0].unionByName(shown[1])


@checked(
    "k10_date_replace",
    f"""WITH {EVENT_FACT} SELECT price_id, CASE WHEN trade_date = DATE '2024-01-15' THEN volume + 1000
    ELSE volume END AS volume FROM fact""",
)
def date_replace(spark, sf_dir):
    rows = store(event_fact(spark, sf_dir), "fact")
    table = open_table(spark, scratch_path(spark, "replaced")).append(rows)
    day = rows.filter("trade_date = DATE'2024-01-15'").withColumn("volume", F.col("volume") + 1000)
    return table.replace_date(day, "2024-01-15").read().select("price_id", "volume")


@checked(
    "k11_repeated_run",
    f"WITH {EVENT_FACT} SELECT month, count(*) AS row_count FROM fact GROUP BY 1",
)
def repeated_run(spark, sf_dir):
    """Snapshot and curated layer written twice hold each row once."""
    target = scratch_path(spark, "target")
    rows = store(event_fact(spark, sf_dir), "fact")
    files = curated.files_for(stored_bytes(spark, f"{sf_dir}/events.parquet"), FILE_BYTES)
    for _ in range(2):
        curated.write_snapshot(rows, target, RUN_DATE, files)
        curated.write_curated(rows, f"{target}/processed")
    table = spark.read.schema(rows.schema).parquet(f"{target}/processed")
    return table.groupBy("month").agg(F.count("*").alias("row_count"))


@checked(
    "k12_insert_if_absent",
    f"""WITH {EVENT_FACT} SELECT price_id, CASE WHEN trade_date < DATE '2024-01-20' THEN volume
    ELSE volume + 1000 END AS volume FROM fact""",
)
def insert_if_absent(spark, sf_dir):
    """Rows the table has are left as they are; repeated new rows go in once."""
    rows = store(event_fact(spark, sf_dir), "fact")
    table = open_table(spark, scratch_path(spark, "inserted")).append(rows.filter("trade_date < DATE'2024-01-20'"))
    staging = rows.withColumn("volume", F.col("volume") + 1000)
    return table.insert_if_absent(staging.unionByName(staging), ("price_id",), fixed_partition=True).read().select("price_id", "volume")


def _append_ship_fact(spark, sf_dir, path):
    """Append the rows of ``ship_fact`` in slices of whole series, so that the disk holds the shuffles of one; returns their schema."""
    slices = curated.files_for(stored_bytes(spark, f"{sf_dir}/lineitem.parquet"), SLICE_BYTES)
    for bars in store_in_slices(ship_bars(spark, sf_dir), "bars", BAR_SERIES.keys, slices):
        rows = daily_fact(bars)
        warehouse.append(rows, path)
    return rows.schema


@checked("k13_compaction", f"WITH {SHIP_FACT} SELECT * FROM fact")
def compaction(spark, sf_dir):
    path = scratch_path(spark, "compacted")
    schema = _append_ship_fact(spark, sf_dir, path)
    warehouse.compact(spark, path)
    return spark.read.schema(schema).parquet(path).select(FACT_COLUMNS)


@checked(
    "k13_incremental_compaction",
    f"""WITH {EVENT_FACT} SELECT count(*) AS row_count, CAST(sum(volume) AS BIGINT) AS volume, TRUE AS fewer_units,
    TRUE AS one_unit_per_partition, TRUE AS older_version_whole, CAST(0 AS BIGINT) AS merged_again FROM fact""",
)
def incremental_compaction(spark, sf_dir):
    """Four appends leave four units a partition; compaction merges them, and once more finds nothing to do."""
    rows = store(event_fact(spark, sf_dir), "fact")
    table = open_table(spark, scratch_path(spark, "units"))
    for part in range(4):
        table.append(rows.filter(F.pmod(F.hash("price_id"), F.lit(4)) == part))
    before = table.version
    merged = table.compact()
    again = table.compact()
    units = table.units().agg(F.count("*").alias("units"), F.countDistinct(F.regexp_extract("unit", "/(.*)$", 1)).alias("partitions")).first()
    older = table.at(before).read().count()
    return table.read().agg(F.count("*").alias("row_count"), F.sum("volume").alias("volume")).select(
        "*", F.lit(merged > units.units).alias("fewer_units"), F.lit(units.units == units.partitions).alias("one_unit_per_partition"),
        (F.col("row_count") == older).alias("older_version_whole"), F.lit(again).cast("long").alias("merged_again"),
    )


@checked(
    "k14_statistics",
    f"WITH {SHIP_BARS} SELECT count(*) AS row_count, count(DISTINCT symbol) > 0 AS has_symbols FROM ship_bars",
)
def statistics(spark, sf_dir):
    """The row count as the optimizer knows it once statistics are refreshed."""
    path = scratch_path(spark, "analyzed")
    curated.write_curated(ship_bars(spark, sf_dir), path, ())
    name = "bars_" + path.rsplit("-", 1)[-1]
    warehouse.register(spark, name, path)
    warehouse.analyze(spark, name, ["symbol", "close_price"])
    known = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Statistics'")
    rows = F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long")
    return known.select(rows.alias("row_count"), (rows > 0).alias("has_symbols"))


def _statistics_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS nulls, CAST(min({c}) AS VARCHAR) AS low,"
        f" CAST(max({c}) AS VARCHAR) AS high, count(DISTINCT {c}) AS distinct_values, TRUE AS close_enough, CAST(0 AS DOUBLE) AS stats_off FROM {table}"
        for c in columns
    )


ANALYZED = ["symbol", "trade_date", "volume", "month"]


@checked("k14_merged_statistics", f"WITH {EVENT_FACT} {_statistics_sql('fact', ANALYZED)}")
def merged_statistics(spark, sf_dir):
    """Statistics of two commits, analyzed one after the other, and merged; sketches are within 5 % of the exact counts."""
    rows = store(event_fact(spark, sf_dir), "fact")
    table = open_table(spark, scratch_path(spark, "sketched")).append(rows.filter("trade_date < DATE'2024-01-20'"))
    table.analyze(ANALYZED)
    table.append(rows.filter("trade_date >= DATE'2024-01-20'"))
    table.analyze(ANALYZED)
    exact = table.read().agg(*[F.countDistinct(c).alias(c) for c in ANALYZED])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("exact")) for c in ANALYZED])))
    close = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.05 * F.col("exact")
    return table.statistics().join(exact, "column_name").select(
        "column_name", "row_count", "nulls", "low", "high", F.col("exact").alias("distinct_values"), close.alias("close_enough"), "stats_off"
    )


@checked(
    "k15_table_profile",
    f"WITH {SHIP_BARS} SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS overlapping_files FROM ship_bars",
)
def table_profile(spark, sf_dir):
    """After compaction no file of a partition overlaps an earlier one in its sort key."""
    path = scratch_path(spark, "profiled")
    schema = _append_ship_fact(spark, sf_dir, path)
    warehouse.compact(spark, path)
    profile = warehouse.profile(spark.read.schema(schema).parquet(path))
    return profile.select("row_count", "overlapping_files")
