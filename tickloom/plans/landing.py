"""Lay derived bars out as files of the landed shapes, for the source queries to read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.schema import RAW_COLUMNS
from tickloom.session import scratch_path
from tickloom.sources.payloads import DAILY_KEYS

PAYLOAD_EVENTS = 10_000
FILE_DOCUMENTS = 1_000


def envelopes(bars: DataFrame) -> DataFrame:
    """One envelope document per symbol. Daily bars: a document is bounded by the calendar."""
    meta = F.struct(
        F.col("symbol"),
        F.max("timestamp").alias("last_refreshed"),
        F.lit("full").alias("output_size"),
        F.lit("US/Eastern").alias("time_zone"),
        F.lit("2024-02-01T00:00:00").alias("ingestion_timestamp"),
        F.lit("derived").alias("data_source"),
    )
    data = F.sort_array(F.collect_list(F.struct("timestamp", F.struct(*RAW_COLUMNS).alias("bar"))), asc=False)
    return bars.groupBy("symbol").agg(
        meta.alias("meta"), F.transform(data, lambda b: b["bar"]).alias("data")
    )


def land_envelopes(bars: DataFrame, execution_date: str, base: str | None = None) -> str:
    """Envelopes as JSON lines under ``stock_data/date=``: many to a file, and no file per symbol."""
    base = base or scratch_path(bars.sparkSession, "landed")
    documents = envelopes(bars).drop("symbol").withColumn("date", F.lit(execution_date))
    # Daily bars, so that no file exceeds the rows that the suite allows a file.
    writer = documents.write.mode("append").option("maxRecordsPerFile", FILE_DOCUMENTS)
    writer.partitionBy("date").json(f"{base}/stock_data")
    return base


def land_named_files(bars: DataFrame, more: dict[str, str]) -> str:
    """One file of JSON lines, a bar each, for every value of ``file``, and files of the given texts."""
    spark = bars.sparkSession
    base = scratch_path(spark, "landed")
    rows = bars.select("file", *RAW_COLUMNS).repartition("file")
    rows.write.partitionBy("file").option("ignoreNullFields", False).json(base)
    texts = spark.createDataFrame(list(more.items()), "file string, value string")
    texts.write.mode("append").partitionBy("file").text(base)
    return base


def land_envelope_files(bars: DataFrame, execution_date: str) -> str:
    """One file per symbol under ``stock_data/date=/symbol=``, for few symbols."""
    base = scratch_path(bars.sparkSession, "landed")
    documents = envelopes(bars).withColumn("date", F.lit(execution_date))
    documents.write.partitionBy("date", "symbol").json(f"{base}/stock_data")
    return base


def land_arrays(bars: DataFrame, path: str) -> None:
    """One text file per symbol holding a top-level array."""
    arrays = bars.groupBy("symbol").agg(F.collect_list(F.struct(*RAW_COLUMNS)).alias("bars"))
    arrays.select(F.to_json("bars").alias("value"), "symbol").write.partitionBy("symbol").text(path)


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def land_daily_payloads(bars: DataFrame) -> str:
    """One payload per symbol and line: a map keyed by date with numbers as text."""
    path = scratch_path(bars.sparkSession, "payloads")
    pairs = [part for column, key in DAILY_KEYS.items() for part in (F.lit(key), _text(column))]
    series = F.map_from_entries(F.collect_list(F.struct("timestamp", F.create_map(*pairs))))
    meta = F.create_map(
        F.lit("2. Symbol"), F.lower("symbol"), F.lit("3. Last Refreshed"), F.max("timestamp")
    )
    bars.groupBy("symbol").agg(
        meta.alias("Meta Data"), series.alias("Time Series (Daily)")
    ).drop("symbol").write.json(path)
    return path


def land_intraday_payloads(events: DataFrame, symbol: Column, interval: str) -> str:
    """Payloads in which every event is a bar of its own; of a symbol's events at one time one stays.

    A payload takes the events of one symbol whose numbers fall in one run of ``PAYLOAD_EVENTS``,
    so none is larger than that, however many events a symbol has.
    """
    path = scratch_path(events.sparkSession, "intraday")
    value = F.col("value").cast("string")
    bar = F.create_map(
        F.lit("1. open"), value, F.lit("2. high"), value, F.lit("3. low"), value,
        F.lit("4. close"), value, F.lit("5. volume"), F.lit("1"),
    )
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    meta = F.create_map(F.lit("2. Symbol"), F.col("symbol"))
    run = F.floor(F.col("event_id") / PAYLOAD_EVENTS)
    (
        events.groupBy(symbol.alias("symbol"), "ts")
        .agg(F.max("value").alias("value"), F.max("event_id").alias("event_id"))
        .groupBy("symbol", run.alias("run"))
        .agg(
            meta.alias("Meta Data"),
            F.map_from_entries(F.collect_list(F.struct(stamp, bar))).alias(f"Time Series ({interval})"),
        )
        .drop("symbol", "run")
        .write.json(path)
    )
    return path


def land_quotes(bars: DataFrame) -> str:
    """One quote payload per symbol from its last bar; the previous close is left out."""
    path = scratch_path(bars.sparkSession, "quotes")
    last = bars.groupBy("symbol").agg(
        F.max(F.struct("timestamp", "open_price", "high_price", "low_price", "close_price", "volume")).alias("b")
    )
    fields = {
        "01. symbol": F.col("symbol"),
        "02. open": F.col("b.open_price"),
        "03. high": F.col("b.high_price"),
        "04. low": F.col("b.low_price"),
        "05. price": F.col("b.close_price"),
        "06. volume": F.col("b.volume"),
        "07. latest trading day": F.col("b.timestamp"),
    }
    pairs = [part for key, column in fields.items() for part in (F.lit(key), column.cast("string"))]
    last.select(F.create_map(*pairs).alias("Global Quote")).write.json(path)
    return path


def land_overviews(dimension: DataFrame) -> str:
    path = scratch_path(dimension.sparkSession, "overviews")
    dimension.select(
        F.col("symbol").alias("Symbol"),
        F.col("company_name").alias("Name"),
        F.col("sector").alias("Sector"),
        F.col("industry").alias("Industry"),
        F.col("exchange").alias("Exchange"),
        F.col("market_cap").cast("string").alias("MarketCapitalization"),
    ).write.json(path)
    return path
