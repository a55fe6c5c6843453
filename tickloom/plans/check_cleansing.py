"""Queries over the cleansing operators, on bars with every kind of defect."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.scalars import surrogate_key, to_number
from tickloom.operators import cleanse as c
from tickloom.operators.enrich import standardise_dates, with_date_dimensions
from tickloom.operators.reports import trend
from tickloom.plans.derived import (
    customer_orders, daily_fact, dirty_bars, event_bars, ship_bars, table,
)
from tickloom.plans.oracle import (
    CLEANSED, DATE_PARTS, DIRTY_BARS, EVENT_BARS, RAW_LIST, SHIP_BARS, fact, letters, positive,
)
from tickloom.plans.registry import checked


@checked(
    "p1_mandatory_keys",
    f'WITH {DIRTY_BARS} SELECT {RAW_LIST} FROM dirty_bars WHERE symbol IS NOT NULL AND "timestamp" IS NOT NULL',
)
def mandatory_keys(spark, sf_dir):
    return c.drop_missing_keys(dirty_bars(spark, sf_dir))


@checked(
    "p2_standard_symbols",
    f"""WITH {DIRTY_BARS} SELECT upper(trim(symbol)) AS symbol, count(*) AS row_count
    FROM dirty_bars GROUP BY 1""",
)
def standard_symbols(spark, sf_dir):
    rows = c.standardise_symbols(dirty_bars(spark, sf_dir))
    return rows.groupBy("symbol").agg(F.count("*").alias("row_count"))


@checked(
    "p3_negative_prices",
    f"""WITH {DIRTY_BARS} SELECT symbol, "timestamp", {positive("open_price")}, {positive("high_price")},
    {positive("low_price")}, {positive("close_price")}, {positive("adjusted_close")} FROM dirty_bars""",
)
def negative_prices(spark, sf_dir):
    return c.null_negative_prices(dirty_bars(spark, sf_dir)).select(
        "symbol", "timestamp", "open_price", "high_price", "low_price", "close_price", "adjusted_close"
    )


@checked(
    "p4_numeric_coercion",
    """SELECT event_id, TRY_CAST(t AS DOUBLE) AS as_double, TRY_CAST(TRY_CAST(t AS DOUBLE) AS BIGINT) AS as_long
    FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'n/a' WHEN event_id % 11 = 0 THEN ''
                 ELSE CAST(event_id AS VARCHAR) || '.0' END AS t FROM events)""",
)
def numeric_coercion(spark, sf_dir):
    number = F.col("event_id")
    text = (
        F.when(number % 7 == 0, "n/a")
        .when(number % 11 == 0, "")
        .otherwise(F.concat(number.cast("string"), F.lit(".0")))
    )
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("t"))
    return rows.select(
        "event_id", to_number("t", "double").alias("as_double"), to_number("t", "bigint").alias("as_long")
    )


@checked(
    "p5_null_defaults",
    f"""WITH {DIRTY_BARS} SELECT symbol, "timestamp", coalesce(volume, 0) AS volume,
    coalesce(dividend_amount, 0) AS dividend_amount, coalesce(split_coefficient, 1) AS split_coefficient
    FROM dirty_bars""",
)
def null_defaults(spark, sf_dir):
    return c.fill_defaults(dirty_bars(spark, sf_dir)).select(
        "symbol", "timestamp", "volume", "dividend_amount", "split_coefficient"
    )


@checked(
    "p6_valid_ohlc",
    f"""WITH {DIRTY_BARS}, priced AS (SELECT symbol, "timestamp", {positive("high_price")}, {positive("low_price")}
    FROM dirty_bars) SELECT * FROM priced
    WHERE high_price IS NULL OR low_price IS NULL OR high_price >= low_price""",
)
def valid_ohlc(spark, sf_dir):
    rows = c.keep_valid_ohlc(c.null_negative_prices(dirty_bars(spark, sf_dir)))
    return rows.select("symbol", "timestamp", "high_price", "low_price")


@checked("p7_cleanse_and_deduplicate", f"WITH {CLEANSED} SELECT {RAW_LIST} FROM cleansed")
def cleanse_and_deduplicate(spark, sf_dir):
    return c.cleanse(dirty_bars(spark, sf_dir))


@checked(
    "p7_hot_copies",
    """SELECT event_type, row_value, first_ts FROM (
      SELECT event_type, floor(value / 1000) AS row_value, min(ts) AS first_ts FROM events GROUP BY 1, 2)""",
)
def hot_copies(spark, sf_dir):
    """Nearly all rows are copies of a few keys; each map task passes on one row per key."""
    rows = table(spark, sf_dir, "events").select(
        "event_type", F.floor(F.col("value") / 1000).cast("double").alias("row_value"),
        F.col("ts").alias("first_ts"),
    )
    return c.deduplicate(rows, ("event_type", "row_value"))


@checked(
    "p8_valid_dates",
    f"""WITH {CLEANSED} SELECT symbol, "timestamp", TRY_CAST("timestamp" AS DATE) AS trade_date,
    TRY_CAST("timestamp" AS TIMESTAMP) AS trade_timestamp FROM cleansed
    WHERE TRY_CAST("timestamp" AS TIMESTAMP) IS NOT NULL""".replace(
        'TRY_CAST("timestamp" AS DATE)', 'CAST(TRY_CAST("timestamp" AS TIMESTAMP) AS DATE)'
    ),
)
def valid_dates(spark, sf_dir):
    return standardise_dates(c.cleanse(dirty_bars(spark, sf_dir))).select(
        "symbol", "timestamp", "trade_date", "trade_timestamp"
    )


@checked(
    "p9_date_dimensions",
    f"""SELECT o_orderkey, {DATE_PARTS}, CAST(isodow(trade_date) AS INTEGER) AS day_of_week_monday
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS trade_date FROM orders)""",
)
def date_dimensions(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("trade_date")
    )
    sunday = with_date_dimensions(rows)
    monday = with_date_dimensions(sunday.withColumnRenamed("day_of_week", "dow"), "monday")
    return monday.withColumnsRenamed({"day_of_week": "day_of_week_monday", "dow": "day_of_week"}).drop("trade_date")


@checked(
    "p10_surrogate_key",
    f"""SELECT {letters("o_custkey")} || '_' || strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS price_id,
    count(*) AS row_count FROM orders GROUP BY 1""",
)
def surrogate_keys(spark, sf_dir):
    rows = customer_orders(spark, sf_dir).select(surrogate_key().alias("price_id"))
    return rows.groupBy("price_id").agg(F.count("*").alias("row_count"))


@checked(
    "p12_fact_columns",
    f"WITH {EVENT_BARS}, {fact('event_bars')} SELECT * FROM fact",
)
def fact_columns(spark, sf_dir):
    """All 28 columns with a fixed processing time (also p11)."""
    return daily_fact(event_bars(spark, sf_dir))


@checked(
    "p13_cleansing_report",
    f"""WITH {CLEANSED} SELECT (SELECT count(*) FROM dirty_bars) AS rows_before,
    (SELECT count(*) FROM cleansed) AS rows_after,
    (SELECT count(*) FROM dirty_bars) - (SELECT count(*) FROM cleansed) AS rows_removed""",
)
def cleansing_report(spark, sf_dir):
    raw = dirty_bars(spark, sf_dir)
    return c.cleansing_report(raw, c.cleanse(raw))


@checked(
    "p14_fact_filters",
    f"""WITH {EVENT_BARS}, {fact('event_bars')} SELECT price_id, close_price, volatility_20d FROM fact
    WHERE trade_date >= DATE '2024-01-15' AND volatility_20d > 0.30""",
)
def fact_filters(spark, sf_dir):
    rows = daily_fact(event_bars(spark, sf_dir))
    return rows.filter("trade_date >= DATE'2024-01-15' AND volatility_20d > 0.30").select(
        "price_id", "close_price", "volatility_20d"
    )


@checked(
    "p15_trend_labels",
    f"""WITH {SHIP_BARS}, {fact('ship_bars')} SELECT price_id,
    CASE WHEN close_price > sma_50 THEN 'BULLISH' ELSE 'BEARISH' END AS trend FROM fact""",
)
def trend_labels(spark, sf_dir):
    return daily_fact(ship_bars(spark, sf_dir)).select("price_id", trend().alias("trend"))
