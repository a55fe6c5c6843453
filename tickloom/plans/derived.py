"""Bars and related tables derived from the driver's tables.

``event_bars``, ``type_bars`` and ``ship_bars`` hold one row per symbol and day, so a
series is bounded by the calendar. ``dirty_bars`` holds one row per event: its series are
not bounded and go through ``cut_long_series``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.indicators import with_indicators
from tickloom.operators.enrich import BAR_SERIES, finish, standardise_dates
from tickloom.schema import RAW_COLUMNS


PRICE_DIGITS = Decimal(10**12)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def letters(number: str) -> Column:
    """A number spelled with A for 0 to J for 9, so that it looks like a ticker."""
    return F.translate(F.col(number).cast("string"), "0123456789", "ABCDEFGHIJ")


def _as_bars(rolled: DataFrame, symbol: Column) -> DataFrame:
    return rolled.select(
        symbol.alias("symbol"),
        F.date_format("day", "yyyy-MM-dd").alias("timestamp"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        F.col("close_price").alias("adjusted_close"),
        F.col("volume").cast("long").alias("volume"),
        F.lit(0.0).alias("dividend_amount"),
        F.lit(1.0).alias("split_coefficient"),
    )


def _event_rollup(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(key, F.to_date("ts").alias("day"))
        .agg(
            F.min_by("value", "ts").alias("open_price"),
            F.max("value").alias("high_price"),
            F.min("value").alias("low_price"),
            F.max_by("value", "ts").alias("close_price"),
            F.count("*").alias("volume"),
        )
    )


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of each user's event values."""
    return _as_bars(_event_rollup(spark, sf_dir, "user_id"), letters("user_id"))


def type_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per event type."""
    return _as_bars(_event_rollup(spark, sf_dir, "event_type"), F.upper("event_type"))


def ship_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of each supplier's unit prices, four decimals, rounded half up."""
    cents = F.floor(F.col("l_extendedprice") * 100.0 + 0.5)
    quantity = F.col("l_quantity").cast("long")
    unit_steps = F.call_function("div", cents * 200 + quantity, quantity * 2)
    # Order key, line number and price as one number: unlike a struct, a number can be
    # updated in place, so the first and last line of a day need no sort.
    line_no = (F.col("l_orderkey") * 16 + F.col("l_linenumber")).cast("decimal(20,0)")
    place = line_no * F.lit(PRICE_DIGITS) + F.col("steps")
    rolled = (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_suppkey", F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber",
            "l_quantity", unit_steps.alias("steps"),
        )
        .withColumn("place", place)
        .groupBy("l_suppkey", "day")
        .agg(
            _price_at(F.min("place")).alias("open_price"),
            (F.max("steps") / 10000.0).alias("high_price"),
            (F.min("steps") / 10000.0).alias("low_price"),
            _price_at(F.max("place")).alias("close_price"),
            F.sum("l_quantity").alias("volume"),
        )
    )
    return _as_bars(rolled, letters("l_suppkey"))


def _price_at(place: Column) -> Column:
    return (place % F.lit(PRICE_DIGITS)).cast("long") / 10000.0


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order under its customer's symbol; these symbols are skewed."""
    return table(spark, sf_dir, "orders").select(
        letters("o_custkey").alias("symbol"),
        F.to_date("o_orderdate").alias("trade_date"),
        "o_orderkey",
        "o_totalprice",
    )


def dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw bar per event, with every defect the cleansing rules know."""
    number = F.col("event_id")
    negated = F.when(number % 101 == 0, -1.0).otherwise(1.0)
    high = (F.col("value") + 1.0) * negated
    low = F.greatest(F.col("value") - 1.0, F.lit(0.0)) * negated
    swapped = number % 103 == 0
    price = F.col("value") * negated
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(number % 97 != 0, letters("user_id")).alias("symbol"),
        F.when(number % 89 == 0, "not-a-date")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("timestamp"),
        price.alias("open_price"),
        F.when(swapped, low).otherwise(high).alias("high_price"),
        F.when(swapped, high).otherwise(low).alias("low_price"),
        price.alias("close_price"),
        price.alias("adjusted_close"),
        F.when(number % 79 != 0, 1 + number % 1000).alias("volume"),
        F.lit(0.0).alias("dividend_amount"),
        F.lit(1.0).alias("split_coefficient"),
    )
    spelled = F.concat(F.lit(" "), F.lower("symbol"), F.lit(" "))
    copies = F.when(number % 83 == 0, F.array("symbol", spelled)).otherwise(F.array("symbol"))
    return rows.withColumn("symbol", F.explode(copies)).select(RAW_COLUMNS)


def daily_fact(bars: DataFrame) -> DataFrame:
    """Fact rows of bars with one row per symbol and day.

    The time of the run is fixed, so that results can be compared.
    """
    run_time = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    return finish(with_indicators(standardise_dates(bars), BAR_SERIES), run_time)


def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_fact(event_bars(spark, sf_dir))


def ship_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_fact(ship_bars(spark, sf_dir))


def supplier_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol dimension of ``ship_bars``: suppliers with their nation and region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    stamp = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            letters("s_suppkey").alias("symbol"),
            F.col("s_name").alias("company_name"),
            F.col("r_name").alias("sector"),
            F.col("n_name").alias("industry"),
            F.lit("LOCAL").alias("exchange"),
            F.floor(F.col("s_acctbal") * 100.0 + 0.5).alias("market_cap"),
            stamp.alias("created_at"),
            stamp.alias("updated_at"),
        )
    )


def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metrics table: event values by type, with errors standing for the success rate."""
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "success_rate")
        .otherwise(F.col("event_type"))
        .alias("metric_name"),
        F.col("value").alias("metric_value"),
        F.col("ts").alias("timestamp"),
    )
