"""Queries over the indicators, on daily bars (bounded series) and on event bars cut into blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tickloom.functions import indicators as ind
from tickloom.operators.cleanse import cleanse
from tickloom.operators.enrich import BAR_SERIES, INDICATOR_DEPTH, finish, standardise_dates
from tickloom.operators.long_series import cut_long_series
from tickloom.operators.quality import check_return_behaviour
from tickloom.operators.recursive_ema import continue_recursive_ema, with_recursive_ema, with_recursive_ema_blocked
from tickloom.plans.derived import daily_fact, dirty_bars, event_bars, ship_bars
from tickloom.plans.oracle import (
    CLEANSED, EVENT_BARS, SHIP_BARS, ema_simple, fact, frame, metrics, previous, sma,
)
from tickloom.plans.registry import checked
from tickloom.session import store

KEY = ["symbol", "trade_date"]


def dated(bars):
    return standardise_dates(bars)


@checked(
    "w1_w4_derived_metrics",
    f"WITH {EVENT_BARS} SELECT symbol, trade_date, {metrics()} FROM event_bars",
)
def derived_metrics(spark, sf_dir):
    return ind.with_derived_metrics(dated(event_bars(spark, sf_dir))).select(
        *KEY, "daily_range", "daily_range_pct", "daily_return", "volume_change_pct"
    )


@checked(
    "w5_moving_averages",
    f"""WITH {SHIP_BARS} SELECT symbol, trade_date, close_price, {sma(5)} AS sma_5, {sma(20)} AS sma_20,
    {sma(50)} AS sma_50 FROM ship_bars""",
)
def moving_averages(spark, sf_dir):
    rows = ind.with_moving_averages(dated(ship_bars(spark, sf_dir)))
    return rows.select(*KEY, "close_price", "sma_5", "sma_20", "sma_50")


@checked(
    "w6_full_window_averages",
    f"""WITH {SHIP_BARS} SELECT symbol, trade_date, {sma(5, min_periods=5)} AS sma_5, {sma(20, min_periods=20)} AS sma_20,
    {sma(50, min_periods=50)} AS sma_50 FROM ship_bars""",
)
def full_window_averages(spark, sf_dir):
    return ind.with_full_window_averages(dated(ship_bars(spark, sf_dir)), (5, 20, 50)).select(
        *KEY, "sma_5", "sma_20", "sma_50"
    )


@checked(
    "w7_simple_ema",
    f"""WITH {SHIP_BARS} SELECT symbol, trade_date, {ema_simple(12)} AS ema_12, {ema_simple(26)} AS ema_26
    FROM ship_bars""",
)
def simple_ema(spark, sf_dir):
    return ind.with_simple_ema(dated(ship_bars(spark, sf_dir))).select(*KEY, "ema_12", "ema_26")


def _recursive(span: int, order: str = "trade_date") -> str:
    """The recursion as a fold over the prices so far."""
    k = f"(CAST(2 AS DOUBLE) / {span + 1})"
    return f"""round(list_reduce(list(close_price) OVER (PARTITION BY symbol ORDER BY {order}
      ROWS UNBOUNDED PRECEDING), lambda a, x: {k} * x + (1 - {k}) * a), 4)"""


@checked(
    "w8_recursive_ema",
    f"""WITH {SHIP_BARS} SELECT symbol, trade_date, {_recursive(12)} AS ema_recursive_12,
    {_recursive(26)} AS ema_recursive_26 FROM ship_bars""",
)
def recursive_ema(spark, sf_dir):
    rows = dated(ship_bars(spark, sf_dir)).select(*KEY, "close_price")
    return with_recursive_ema(rows).drop("close_price")


@checked(
    "w9_volatility",
    f"""WITH {SHIP_BARS}, returns AS (SELECT symbol, trade_date, {metrics()} FROM ship_bars)
    SELECT symbol, trade_date, round(stddev_samp(daily_return) {frame(20)}, 4) AS volatility_20d FROM returns""",
)
def rolling_volatility(spark, sf_dir):
    returns = ind.with_derived_metrics(dated(ship_bars(spark, sf_dir)))
    return ind.with_volatility(returns).select(*KEY, "volatility_20d")


@checked(
    "w10_full_window_volatility",
    f"""WITH {SHIP_BARS}, returns AS (SELECT symbol, trade_date, {metrics()} FROM ship_bars)
    SELECT symbol, trade_date, CASE WHEN count(daily_return) {frame(20)} >= 20
      THEN round(stddev_samp(daily_return) {frame(20)}, 4) END AS volatility_20d FROM returns""",
)
def full_window_volatility(spark, sf_dir):
    returns = ind.with_derived_metrics(dated(ship_bars(spark, sf_dir)))
    return ind.with_volatility(returns, min_periods=20).select(*KEY, "volatility_20d")


@checked(
    "w11_log_returns",
    f"""WITH {SHIP_BARS} SELECT symbol, trade_date,
    CASE WHEN {previous("close_price")} > 0 AND close_price > 0
      THEN round(ln(close_price / {previous("close_price")}), 10) END AS log_return FROM ship_bars""",
)
def log_returns(spark, sf_dir):
    rows = ind.with_log_returns(dated(ship_bars(spark, sf_dir)))
    return rows.select(*KEY, F.round("log_return", 10).alias("log_return"))


@checked(
    "w12_enriched_fact",
    f"WITH {SHIP_BARS}, {fact('ship_bars')} SELECT * FROM fact",
)
def enriched_fact(spark, sf_dir):
    return daily_fact(ship_bars(spark, sf_dir))


DATED = f"""{CLEANSED}, dated AS (
  SELECT *, CAST(TRY_CAST("timestamp" AS TIMESTAMP) AS DATE) AS trade_date FROM cleansed
  WHERE TRY_CAST("timestamp" AS TIMESTAMP) IS NOT NULL)"""
BY_TIME = 'trade_date, "timestamp"'


@checked(
    "w12_enriched_long_series",
    f"""WITH {DATED}, {fact('dated', order=BY_TIME, trade_timestamp='CAST("timestamp" AS TIMESTAMP)')}
    SELECT * FROM fact""",
)
def enriched_long_series(spark, sf_dir):
    """One bar per event, so a symbol may hold any share of the rows: cut into blocks of few rows."""
    bars = store(standardise_dates(cleanse(dirty_bars(spark, sf_dir))), "dated")
    blocked = cut_long_series(bars, BAR_SERIES, INDICATOR_DEPTH, rows_per_block=16)
    return finish(
        blocked.apply(ind.with_indicators), F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    )


def _recursive_with_gaps(span: int) -> str:
    """The recursion where prices are missing: the average carries on while its weight decays, so that the next
    price counts k / (k + (1 - k)^(m + 1)) after m missing ones. ``seen`` has the prices and the gaps before them."""
    k = f"(CAST(2 AS DOUBLE) / {span + 1})"
    weight = f"({k} / ({k} + (1 - {k}) ** (x.gap + 1)))"
    return f"""round(list_reduce(seen, lambda a, x: {{'price': {weight} * x.price + (1 - {weight}) * a.price, 'gap': 0::BIGINT}}).price, 4)"""


GAPPED_AVERAGES = f"""WITH {DATED}, placed AS (
      SELECT symbol, "timestamp", trade_date, close_price, row_number() OVER (PARTITION BY symbol ORDER BY {BY_TIME}) AS place FROM dated),
    gaps AS (
      SELECT *, CASE WHEN close_price IS NOT NULL THEN {{'price': close_price, 'gap': coalesce(place - 1 - max(CASE WHEN close_price IS NOT NULL THEN place END)
        OVER (PARTITION BY symbol ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)}} END AS x FROM placed),
    lists AS (
      SELECT symbol, "timestamp", list(x) FILTER (x IS NOT NULL) OVER (PARTITION BY symbol ORDER BY place ROWS UNBOUNDED PRECEDING) AS seen FROM gaps)
    SELECT symbol, "timestamp", {_recursive_with_gaps(12)} AS ema_recursive_12, {_recursive_with_gaps(26)} AS ema_recursive_26 FROM lists"""


@checked("w8_recursive_ema_long_series", GAPPED_AVERAGES)
def recursive_ema_long_series(spark, sf_dir):
    """All rows, also those without a price, in blocks of few rows."""
    bars = standardise_dates(cleanse(dirty_bars(spark, sf_dir)))
    rows = store(bars.select("symbol", "timestamp", "trade_date", "trade_timestamp", "close_price"), "closes")
    blocked = cut_long_series(rows, BAR_SERIES, 0, rows_per_block=32)
    return with_recursive_ema_blocked(blocked).select("symbol", "timestamp", "ema_recursive_12", "ema_recursive_26")


@checked("w8_recursive_ema_increments", GAPPED_AVERAGES)
def recursive_ema_increments(spark, sf_dir):
    """Four increments, each from the states that the one before left."""
    bars = standardise_dates(cleanse(dirty_bars(spark, sf_dir)))
    rows = store(bars.select("symbol", "timestamp", "trade_date", "trade_timestamp", "close_price"), "closes")
    states, done = None, []
    for part in ("timestamp < '2024-01-05'", "timestamp >= '2024-01-05' AND timestamp < '2024-01-06'",
                 "timestamp >= '2024-01-06' AND timestamp < '2024-01-20'", "timestamp >= '2024-01-20'"):
        averaged, after = continue_recursive_ema(rows.filter(part), states, series=BAR_SERIES)
        states = store(after, "states")
        done.append(averaged.select("symbol", "timestamp", "ema_recursive_12", "ema_recursive_26"))
    return reduce(DataFrame.unionByName, done)


@checked(
    "a16_return_diagnostics",
    f"""WITH {SHIP_BARS}, moves AS (SELECT symbol, close_price,
      CASE WHEN {previous("close_price")} > 0 AND close_price > 0
        THEN ln(close_price / {previous("close_price")}) END AS log_return,
      CASE WHEN {previous("close_price")} > 0
        THEN (close_price - {previous("close_price")}) / {previous("close_price")} END AS change FROM ship_bars)
    SELECT symbol, count(log_return) AS returns, round(skewness(log_return), 6) AS log_return_skewness,
      round(max(abs(change)), 6) AS greatest_move, min(close_price) AS lowest_close,
      abs(skewness(log_return)) < 2 AS skewness_ok, max(abs(change)) < 0.5 AS returns_ok,
      max(abs(change)) < 0.2 AS jumps_ok, bool_and(close_price > 0) AS prices_positive
    FROM moves GROUP BY 1""",
)
def return_diagnostics(spark, sf_dir):
    return check_return_behaviour(ind.with_log_returns(dated(ship_bars(spark, sf_dir))))


@checked(
    "t4_series_order",
    f"""WITH {EVENT_BARS} SELECT symbol, trade_date,
    row_number() OVER (PARTITION BY symbol ORDER BY trade_date) AS place FROM event_bars""",
)
def series_order(spark, sf_dir):
    rows = dated(event_bars(spark, sf_dir))
    return rows.select(*KEY, F.row_number().over(ind.DAILY.ordered()).cast("long").alias("place"))
