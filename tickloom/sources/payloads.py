"""Landed responses of a market-data API: maps keyed by date, numbers as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import to_number
from tickloom.schema import DIM_SYMBOLS_SCHEMA, RAW_SCHEMA

INTERVALS = ("1min", "5min", "15min", "30min", "60min")

# Fixed keys of the payloads, by the column they fill.
DAILY_KEYS = {
    "open_price": "1. open",
    "high_price": "2. high",
    "low_price": "3. low",
    "close_price": "4. close",
    "adjusted_close": "5. adjusted close",
    "volume": "6. volume",
    "dividend_amount": "7. dividend amount",
    "split_coefficient": "8. split coefficient",
}
INTRADAY_KEYS = {
    "open_price": "1. open",
    "high_price": "2. high",
    "low_price": "3. low",
    "close_price": "4. close",
    "volume": "5. volume",
}
QUOTE_NUMBERS = {
    "open": "02. open",
    "high": "03. high",
    "low": "04. low",
    "price": "05. price",
    "volume": "06. volume",
    "previous_close": "08. previous close",
    "change": "09. change",
}
OVERVIEW_KEYS = {
    "symbol": "Symbol",
    "company_name": "Name",
    "sector": "Sector",
    "industry": "Industry",
    "exchange": "Exchange",
    "market_cap": "MarketCapitalization",
}

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
_SERIES_MAP = T.MapType(T.StringType(), _TEXT_MAP)


def _read(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """Payloads, one per file or (``multi_line`` off) one per line, which large files can be split by."""
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def _series_rows(payloads: DataFrame, series_key: str, keys: dict[str, str]) -> DataFrame:
    types = {f.name: f.dataType.simpleString() for f in RAW_SCHEMA}
    values = [
        to_number(F.col("bar")[key], types[c]).alias(c) for c, key in keys.items()
    ]
    return payloads.select(
        F.upper(F.col("Meta Data")["2. Symbol"]).alias("symbol"),
        F.explode(F.col(series_key)).alias("timestamp", "bar"),
        "source_file",
    ).select("symbol", "timestamp", *values, "source_file")


def read_daily(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Raw bars from daily payloads."""
    return _series_rows(_daily_payloads(spark, path, multi_line), "Time Series (Daily)", DAILY_KEYS)


def read_daily_meta(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per daily payload: what it says about itself."""
    meta = F.col("Meta Data")
    return _daily_payloads(spark, path, multi_line).select(
        meta["2. Symbol"].alias("symbol"),
        meta["3. Last Refreshed"].alias("last_refreshed"),
        F.coalesce(meta["4. Output Size"], F.lit("unknown")).alias("output_size"),
        F.coalesce(meta["5. Time Zone"], F.lit("US/Eastern")).alias("time_zone"),
        "source_file",
    )


def _daily_payloads(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    return _read(
        spark,
        path,
        T.StructType(
            [T.StructField("Meta Data", _TEXT_MAP), T.StructField("Time Series (Daily)", _SERIES_MAP)]
        ),
        multi_line,
    )


def read_intraday(
    spark: SparkSession, path: str, interval: str = "5min", multi_line: bool = True
) -> DataFrame:
    """Bars from intraday payloads of one interval."""
    if interval not in INTERVALS:
        raise ValueError(f"interval must be one of {', '.join(INTERVALS)}, not {interval!r}")
    key = f"Time Series ({interval})"
    schema = T.StructType([T.StructField("Meta Data", _TEXT_MAP), T.StructField(key, _SERIES_MAP)])
    return _series_rows(_read(spark, path, schema, multi_line), key, INTRADAY_KEYS)


def read_quotes(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per quote payload; missing numbers are 0. Empty payloads give no row."""
    quote = F.col("Global Quote")
    schema = T.StructType([T.StructField("Global Quote", _TEXT_MAP)])
    payloads = _read(spark, path, schema, multi_line)

    def number(name: str) -> Column:
        dtype = "bigint" if name == "volume" else "double"
        return F.coalesce(to_number(quote[QUOTE_NUMBERS[name]], dtype), F.lit(0).cast(dtype)).alias(name)

    return payloads.filter(F.size(quote) > 0).select(
        quote["01. symbol"].alias("symbol"),
        *[number(n) for n in ["open", "high", "low", "price", "volume"]],
        F.coalesce(quote["07. latest trading day"], F.lit("")).alias("latest_trading_day"),
        number("previous_close"),
        number("change"),
        F.coalesce(quote["10. change percent"], F.lit("0%")).alias("change_percent"),
    )


def read_overviews(
    spark: SparkSession, path: str, loaded_at: Column | None = None, multi_line: bool = True
) -> DataFrame:
    """The symbol dimension from company overview payloads; payloads without a symbol give no row."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    schema = T.StructType([T.StructField(k, T.StringType()) for k in OVERVIEW_KEYS.values()])
    named = {c: F.col(k) for c, k in OVERVIEW_KEYS.items()}
    named["market_cap"] = to_number(named["market_cap"], "bigint")
    named["created_at"] = named["updated_at"] = stamp.cast("timestamp")
    rows = _read(spark, path, schema, multi_line).filter(F.col("Symbol").isNotNull())
    return rows.select([named[c].alias(c) for c in DIM_SYMBOLS_SCHEMA.fieldNames()])
