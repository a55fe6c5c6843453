"""Queries over the sources: bars are written in each landed shape and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.plans import landing
from tickloom.plans.derived import (
    dirty_bars, event_bars, letters, ship_bars, supplier_dimension, table, type_bars,
)
from tickloom.plans.oracle import (
    DIRTY_BARS, EVENT_BARS, RAW_LIST, RUN_TIME, SHIP_BARS, TYPE_BARS, steps,
)
from tickloom.plans.oracle import letters as sql_letters
from tickloom.plans.registry import checked
from tickloom.schema import RAW_COLUMNS, RAW_SCHEMA
from tickloom.session import scratch_path
from tickloom.sinks.curated import write_curated, write_snapshot
from tickloom.sources import files, json_bars, payloads, text_tables

RUN_DATE = "2024-01-31"


@checked("s1_date_partition_scan", f"WITH {TYPE_BARS} SELECT {RAW_LIST} FROM type_bars")
def date_partition_scan(spark, sf_dir):
    """One multi-line file per symbol."""
    base = landing.land_envelope_files(type_bars(spark, sf_dir), RUN_DATE)
    return json_bars.read_date_partition(spark, base, RUN_DATE).select(RAW_COLUMNS)


@checked("s1_date_partition_lines", f"WITH {EVENT_BARS} SELECT {RAW_LIST} FROM event_bars")
def date_partition_lines(spark, sf_dir):
    base = landing.land_envelopes(event_bars(spark, sf_dir), RUN_DATE)
    return json_bars.read_date_partition(spark, base, RUN_DATE, multi_line=False).select(RAW_COLUMNS)


@checked("s2_envelope_flatten", f"WITH {SHIP_BARS} SELECT {RAW_LIST} FROM ship_bars")
def envelope_flatten(spark, sf_dir):
    """Envelopes as JSON lines, many to a file, so that Spark can split the files."""
    path = scratch_path(spark, "lines")
    landing.envelopes(ship_bars(spark, sf_dir)).drop("symbol").write.json(path)
    return json_bars.read_bars(spark, path, multi_line=False).select(RAW_COLUMNS)


@checked(
    "s3_directory_scan",
    f"""WITH {TYPE_BARS} SELECT {RAW_LIST} FROM type_bars UNION ALL SELECT {RAW_LIST} FROM type_bars""",
)
def directory_scan(spark, sf_dir):
    """Envelopes and top-level arrays at different depths, beside a file that is no JSON."""
    bars = type_bars(spark, sf_dir)
    base = landing.land_envelope_files(bars, RUN_DATE)
    landing.land_arrays(bars, f"{base}/arrays")
    table(spark, sf_dir, "region").select(F.concat(F.lit("{ no json "), "r_name")).coalesce(1).write.text(
        f"{base}/arrays/broken"
    )
    return json_bars.scan_directory(spark, base, pattern="*.{json,txt}").select(RAW_COLUMNS)


@checked(
    "s4_read_by_extension",
    f"""WITH {TYPE_BARS} SELECT format, count(*) AS row_count, CAST(sum(volume) AS BIGINT) AS volume,
    CAST(sum({steps()}) AS BIGINT) AS close_steps
    FROM type_bars, (VALUES ('csv'), ('json'), ('parquet'), ('unknown')) f(format) GROUP BY 1""",
)
def read_by_extension(spark, sf_dir):
    """Each format by the same operator; CSV files differ in the order of their columns."""
    bars = type_bars(spark, sf_dir)
    base = scratch_path(spark, "formats")
    bars.write.parquet(f"{base}/bars.parquet")
    stored = spark.read.parquet(f"{base}/bars.parquet")
    # Files with the same columns in another order stand beside each other.
    odd = F.col("volume") % 2 == 1
    for name in ("csv", "dat"):
        stored.where(odd).write.option("header", True).csv(f"{base}/bars.{name}")
        stored.where(~odd).select(RAW_COLUMNS[::-1]).write.mode("append").option("header", True).csv(f"{base}/bars.{name}")
    # One envelope per file: there are few symbols.
    landing.envelopes(stored).write.partitionBy("symbol").json(f"{base}/bars.json")
    read = {
        "csv": files.read_by_extension(spark, f"{base}/bars.csv"),
        "json": files.read_by_extension(spark, f"{base}/bars.json"),
        "parquet": files.read_by_extension(spark, f"{base}/bars.parquet"),
        "unknown": files.read_by_extension(spark, f"{base}/bars.dat"),
    }
    together = None
    for name, rows in read.items():
        part = rows.select(F.lit(name).alias("format"), "volume", "close_price")
        together = part if together is None else together.unionByName(part)
    close_steps = F.floor(F.col("close_price") * 10000.0 + 0.5)
    return together.groupBy("format").agg(
        F.count("*").alias("row_count"),
        F.sum("volume").alias("volume"),
        F.sum(close_steps).alias("close_steps"),
    )


@checked("s5_daily_payloads", f"WITH {EVENT_BARS} SELECT {RAW_LIST} FROM event_bars")
def daily_payloads(spark, sf_dir):
    path = landing.land_daily_payloads(event_bars(spark, sf_dir))
    return payloads.read_daily(spark, path, multi_line=False).select(RAW_COLUMNS)


@checked(
    "s5_daily_payload_meta",
    f"""WITH {EVENT_BARS} SELECT lower(symbol) AS symbol, max("timestamp") AS last_refreshed,
    'unknown' AS output_size, 'US/Eastern' AS time_zone FROM event_bars GROUP BY symbol""",
)
def daily_payload_meta(spark, sf_dir):
    path = landing.land_daily_payloads(event_bars(spark, sf_dir))
    return payloads.read_daily_meta(spark, path, multi_line=False).drop("source_file")


@checked(
    "s6_quotes",
    f"""WITH {EVENT_BARS} SELECT symbol, open_price AS open, high_price AS high, low_price AS low,
    close_price AS price, volume, "timestamp" AS latest_trading_day, CAST(0 AS DOUBLE) AS previous_close,
    CAST(0 AS DOUBLE) AS change, '0%' AS change_percent FROM event_bars
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) = 1""",
)
def quotes(spark, sf_dir):
    return payloads.read_quotes(spark, landing.land_quotes(event_bars(spark, sf_dir)), multi_line=False)


@checked(
    "s7_intraday_payloads",
    f"""SELECT {sql_letters("user_id")} AS symbol, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
    max(value) AS open_price, max(value) AS high_price, max(value) AS low_price, max(value) AS close_price,
    CAST(1 AS BIGINT) AS volume FROM events GROUP BY user_id, ts""",
)
def intraday_payloads(spark, sf_dir):
    path = landing.land_intraday_payloads(table(spark, sf_dir, "events"), letters("user_id"), "5min")
    return payloads.read_intraday(spark, path, "5min", multi_line=False).drop("source_file")


@checked(
    "s8_symbol_dimension",
    f"""SELECT {sql_letters("s_suppkey")} AS symbol, s_name AS company_name, r_name AS sector,
    n_name AS industry, 'LOCAL' AS exchange, CAST(floor(s_acctbal * 100 + 0.5) AS BIGINT) AS market_cap,
    {RUN_TIME} AS created_at, {RUN_TIME} AS updated_at
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def symbol_dimension(spark, sf_dir):
    path = landing.land_overviews(supplier_dimension(spark, sf_dir))
    stamp = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    return payloads.read_overviews(spark, path, stamp, multi_line=False)


@checked(
    "s9_load_formats",
    f"""WITH {EVENT_BARS} SELECT format, {RAW_LIST}
    FROM event_bars, (VALUES ('CSV'), ('JSON'), ('PARQUET')) f(format)""",
)
def load_formats(spark, sf_dir):
    """Loads by the table's schema: every column of every row in its type, whatever the format."""
    bars = event_bars(spark, sf_dir)
    base = scratch_path(spark, "loads")
    bars.write.parquet(f"{base}/parquet")
    stored = spark.read.parquet(f"{base}/parquet")
    odd = F.col("volume") % 2 == 1
    stored.where(odd).write.option("header", True).option("sep", "|").csv(f"{base}/csv")
    stored.where(~odd).select(RAW_COLUMNS[::-1]).write.mode("append").option("header", True).option("sep", "|").csv(f"{base}/csv")
    stored.write.json(f"{base}/json")
    together = None
    for name in ("PARQUET", "CSV", "JSON"):
        rows = files.read_for_load(spark, f"{base}/{name.lower()}", name, delimiter="|", schema=RAW_SCHEMA)
        part = rows.select(F.lit(name).alias("format"), *RAW_COLUMNS)
        together = part if together is None else together.unionByName(part)
    return together


@checked(
    "s10_sql_over_parquet",
    f"""WITH {EVENT_BARS} SELECT symbol, count(*) AS record_count, max(high_price) AS high_price
    FROM event_bars GROUP BY 1""",
)
def sql_over_parquet(spark, sf_dir):
    path = scratch_path(spark, "bars")
    event_bars(spark, sf_dir).write.parquet(path)
    return files.query_parquet(
        spark,
        path,
        "SELECT symbol, count(*) AS record_count, max(high_price) AS high_price FROM {bars} GROUP BY symbol",
    )


@checked("s11_snapshot_read", f"WITH {EVENT_BARS} SELECT {RAW_LIST} FROM event_bars")
def snapshot_read(spark, sf_dir):
    target = scratch_path(spark, "target")
    write_snapshot(event_bars(spark, sf_dir), target, "2024-01-30")
    write_snapshot(event_bars(spark, sf_dir), target, RUN_DATE)
    return files.read_snapshot(spark, target, RUN_DATE)


@checked(
    "s12_file_inventory",
    f"WITH {SHIP_BARS} SELECT count(*) AS row_count, TRUE AS has_files, TRUE AS has_bytes FROM ship_bars",
)
def file_inventory(spark, sf_dir):
    path = scratch_path(spark, "inventory")
    write_curated(ship_bars(spark, sf_dir), path, ())
    summary = files.output_summary(spark.read.parquet(path))
    return summary.select(
        "row_count", (F.col("files") > 0).alias("has_files"), (F.col("megabytes") > 0).alias("has_bytes")
    )


LOADED = "symbol string, timestamp string, volume bigint, close_price double"


@checked(
    "s13_error_positions",
    f"""WITH {EVENT_BARS}, lines AS (
      SELECT symbol, "timestamp", day(trade_date) AS d, row_number() OVER (ORDER BY symbol, "timestamp") AS line FROM event_bars),
    errors AS (
      SELECT TIMESTAMP '2024-02-02 00:00:00' AS load_time, 'json' AS file, line,
             CASE WHEN d % 7 <> 0 THEN 'volume' END AS column_name,
             CASE WHEN d % 7 <> 0 THEN length('{{"symbol":"' || symbol || '","timestamp":"' || "timestamp" || '","volume":') + 1 END AS position,
             CASE WHEN d % 7 = 0 THEN '{{ "symbol": ' || symbol ELSE 'many' END AS raw_value,
             CASE WHEN d % 7 = 0 THEN 'no JSON' ELSE 'not a bigint' END AS reason
      FROM lines WHERE d % 7 = 0 OR d % 5 = 0
      UNION ALL
      SELECT TIMESTAMP '2024-02-01 00:00:00', 'csv', line + 1, 'volume', length(symbol) + length("timestamp") + 3, 'many', 'not a bigint'
      FROM lines WHERE d % 5 = 0)
    SELECT load_time, file, CAST(line AS BIGINT) AS line, column_name, CAST(position AS INTEGER) AS position, raw_value, reason
    FROM errors""",
)
def error_positions(spark, sf_dir):
    """Volumes spelled as a word and broken lines of two loads, with file, line, column and place in the line."""
    base = scratch_path(spark, "rejects")
    day = F.dayofmonth(F.to_date("timestamp"))
    volume = F.when(day % 5 == 0, "many").otherwise(F.col("volume").cast("string")).alias("volume")
    bars = event_bars(spark, sf_dir).select("symbol", "timestamp", volume, "close_price")
    # One file each, so that SQL knows the line numbers.
    bars = bars.repartition(1).sortWithinPartitions("symbol", "timestamp")
    bars.write.option("header", True).csv(f"{base}/csv")
    broken = F.concat(F.lit('{ "symbol": '), "symbol")
    bars.select(F.when(day % 7 == 0, broken).otherwise(F.to_json(F.struct(*bars.columns)))).write.text(f"{base}/json")
    schema = StructType.fromDDL(LOADED)
    older, newer = (F.to_timestamp(F.lit(f"2024-02-0{n} 00:00:00")) for n in (1, 2))
    errors = text_tables.load_errors(spark, f"{base}/json", schema, newer, "JSON").unionByName(
        text_tables.load_errors(spark, f"{base}/csv", schema, older, "CSV")
    )
    return errors.withColumn("file", F.regexp_extract("source_file", "/(csv|json)/[^/]*$", 1)).drop("source_file")


@checked(
    "s13_load_errors",
    f"""WITH {DIRTY_BARS} SELECT "timestamp", 'volume' AS column_name, 'many' AS raw_value,
    'not a bigint' AS reason FROM dirty_bars WHERE volume IS NULL ORDER BY "timestamp" LIMIT 10""",
)
def load_errors(spark, sf_dir):
    """Missing volumes spelled as a word: the newest rejects with file, column and reason."""
    path = scratch_path(spark, "rejects")
    rows = dirty_bars(spark, sf_dir).withColumn(
        "volume", F.coalesce(F.col("volume").cast("string"), F.lit("many"))
    )
    rows.write.json(path)
    documents = json_bars.read_documents(spark, path, multi_line=False)
    stamp = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    rejects = json_bars.rejected_values(json_bars.text_bars(documents), stamp)
    newest = rejects.drop("source_file").withColumn("source_file", F.lit("one file"))
    return json_bars.latest_load_errors(newest).select("timestamp", "column_name", "raw_value", "reason")
