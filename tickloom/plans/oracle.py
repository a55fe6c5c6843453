"""SQL fragments for checking results: the derived tables and indicators in plain SQL."""

from __future__ import annotations

RUN_TIME = "TIMESTAMP '2024-02-01 00:00:00'"


def letters(column: str) -> str:
    return f"translate(CAST({column} AS VARCHAR), '0123456789', 'ABCDEFGHIJ')"


def _event_bars(name: str, key: str, symbol: str) -> str:
    return f"""{name} AS (
  SELECT {symbol} AS symbol, strftime(day, '%Y-%m-%d') AS "timestamp", day AS trade_date,
         open_price, high_price, low_price, close_price, close_price AS adjusted_close, volume,
         CAST(0 AS DOUBLE) AS dividend_amount, CAST(1 AS DOUBLE) AS split_coefficient
  FROM (SELECT {key}, CAST(ts AS DATE) AS day, arg_min(value, ts) AS open_price,
               max(value) AS high_price, min(value) AS low_price,
               arg_max(value, ts) AS close_price, count(*) AS volume
        FROM events GROUP BY 1, 2))"""


EVENT_BARS = _event_bars("event_bars", "user_id", letters("user_id"))
TYPE_BARS = _event_bars("type_bars", "event_type", "upper(event_type)")

SHIP_BARS = f"""ship_lines AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber, l_quantity,
         (CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) * 200 + CAST(l_quantity AS BIGINT))
           // (CAST(l_quantity AS BIGINT) * 2) AS steps
  FROM lineitem),
ship_bars AS (
  SELECT {letters("l_suppkey")} AS symbol, strftime(day, '%Y-%m-%d') AS "timestamp", day AS trade_date,
         open_price, high_price, low_price, close_price, close_price AS adjusted_close, volume,
         CAST(0 AS DOUBLE) AS dividend_amount, CAST(1 AS DOUBLE) AS split_coefficient
  FROM (SELECT l_suppkey, day,
               arg_min(steps, (l_orderkey, l_linenumber, steps)) / CAST(10000 AS DOUBLE) AS open_price,
               max(steps) / CAST(10000 AS DOUBLE) AS high_price,
               min(steps) / CAST(10000 AS DOUBLE) AS low_price,
               arg_max(steps, (l_orderkey, l_linenumber, steps)) / CAST(10000 AS DOUBLE) AS close_price,
               CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM ship_lines GROUP BY 1, 2))"""

CUSTOMER_ORDERS = f"""customer_orders AS (
  SELECT {letters("o_custkey")} AS symbol, CAST(o_orderdate AS DATE) AS trade_date,
         o_orderkey, o_totalprice
  FROM orders)"""

DIRTY_BARS = f"""dirty_numbered AS (
  SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN {letters("user_id")} END AS symbol,
         CASE WHEN event_id % 89 = 0 THEN 'not-a-date'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS "timestamp",
         CASE WHEN event_id % 101 = 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS negated,
         value, greatest(value - 1, 0) AS lower_value,
         CASE WHEN event_id % 79 <> 0 THEN 1 + event_id % 1000 END AS volume
  FROM events),
dirty_priced AS (
  SELECT event_id, symbol, "timestamp", value * negated AS open_price,
         CASE WHEN event_id % 103 = 0 THEN lower_value * negated ELSE (value + 1) * negated END AS high_price,
         CASE WHEN event_id % 103 = 0 THEN (value + 1) * negated ELSE lower_value * negated END AS low_price,
         value * negated AS close_price, value * negated AS adjusted_close, volume,
         CAST(0 AS DOUBLE) AS dividend_amount, CAST(1 AS DOUBLE) AS split_coefficient
  FROM dirty_numbered),
dirty_bars AS (
  SELECT * EXCLUDE (event_id) FROM dirty_priced
  UNION ALL
  SELECT * EXCLUDE (event_id) REPLACE (' ' || lower(symbol) || ' ' AS symbol)
  FROM dirty_priced WHERE event_id % 83 = 0)"""


def positive(column: str) -> str:
    return f"CASE WHEN {column} >= 0 THEN {column} END AS {column}"


CLEANSED = f"""{DIRTY_BARS},
cleansed_all AS (
  SELECT upper(trim(symbol)) AS symbol, "timestamp",
         {positive("open_price")}, {positive("high_price")}, {positive("low_price")},
         {positive("close_price")}, {positive("adjusted_close")}, coalesce(volume, 0) AS volume,
         coalesce(dividend_amount, 0) AS dividend_amount, coalesce(split_coefficient, 1) AS split_coefficient
  FROM dirty_bars WHERE symbol IS NOT NULL AND "timestamp" IS NOT NULL),
cleansed AS (
  SELECT * EXCLUDE (copy_no) FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, "timestamp"
             ORDER BY open_price, high_price, low_price, close_price, adjusted_close, volume) AS copy_no
    FROM cleansed_all
    WHERE high_price IS NULL OR low_price IS NULL OR high_price >= low_price)
  WHERE copy_no = 1)"""


def steps(price: str = "close_price") -> str:
    return f"CAST(floor({price} * 10000 + 0.5) AS BIGINT)"


def half_up_mean(total: str, n: str, decimals: int = 4) -> str:
    unit = 10 ** (4 - decimals)
    return (
        f"CASE WHEN {n} > 0 THEN CAST(sign({total}) * ((2 * abs({total}) + {n} * {unit})"
        f" // ({n} * {2 * unit})) AS DOUBLE) / {10 ** decimals} END"
    )


def frame(n: int, order: str = "trade_date") -> str:
    return (
        f"OVER (PARTITION BY symbol ORDER BY {order}"
        f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    )


def sma(n: int, order: str = "trade_date", min_periods: int = 1) -> str:
    total, count = f"sum({steps()}) {frame(n, order)}", f"count(close_price) {frame(n, order)}"
    return f"CASE WHEN {count} >= {min_periods} THEN {half_up_mean(total, count)} END"


def ema_simple(n: int, order: str = "trade_date") -> str:
    """mean * 2/(n+1) + close * (n-1)/(n+1) as one fraction, rounded half up; prices are not negative."""
    total, count = f"sum({steps()}) {frame(n, order)}", f"count(close_price) {frame(n, order)}"
    numerator = f"(2 * {total} + {count} * {steps()} * {n - 1})"
    rounded = f"(2 * {numerator} + {count} * {n + 1}) // (2 * {count} * {n + 1})"
    return f"CASE WHEN close_price IS NOT NULL THEN CAST({rounded} AS DOUBLE) / 10000 END"


def previous(column: str, order: str = "trade_date") -> str:
    return f"lag({column}) OVER (PARTITION BY symbol ORDER BY {order})"


def metrics(order: str = "trade_date") -> str:
    close, volume = previous("close_price", order), previous("volume", order)
    return f"""high_price - low_price AS daily_range,
         CASE WHEN close_price > 0 THEN (high_price - low_price) / close_price * 100 END AS daily_range_pct,
         CASE WHEN {close} > 0 THEN (close_price - {close}) / {close} * 100 END AS daily_return,
         CASE WHEN {volume} > 0 THEN CAST(volume - {volume} AS DOUBLE) / CAST({volume} AS DOUBLE) * 100 END
           AS volume_change_pct"""


DATE_PARTS = """CAST(year(trade_date) AS INTEGER) AS year, CAST(quarter(trade_date) AS INTEGER) AS quarter,
         CAST(month(trade_date) AS INTEGER) AS month, CAST(day(trade_date) AS INTEGER) AS day,
         CAST(dayofweek(trade_date) + 1 AS INTEGER) AS day_of_week"""


def fact(bars: str, name: str = "fact", order: str = "trade_date", trade_timestamp: str = "CAST(trade_date AS TIMESTAMP)") -> str:
    """CTEs of the fact rows of a table of bars that has ``trade_date``."""
    return f"""{name}_returns AS (
  SELECT *, {trade_timestamp} AS trade_timestamp, {metrics(order)} FROM {bars}),
{name} AS (
  SELECT symbol || '_' || strftime(trade_date, '%Y%m%d') AS price_id, symbol, trade_date, trade_timestamp,
         open_price, high_price, low_price, close_price, adjusted_close, volume, dividend_amount,
         split_coefficient, daily_return, daily_range, daily_range_pct, volume_change_pct,
         {sma(5, order)} AS sma_5, {sma(20, order)} AS sma_20, {sma(50, order)} AS sma_50,
         {ema_simple(12, order)} AS ema_12, {ema_simple(26, order)} AS ema_26,
         round(stddev_samp(daily_return) {frame(20, order)}, 4) AS volatility_20d,
         {DATE_PARTS},
         {RUN_TIME} AS processing_timestamp
  FROM {name}_returns)"""


RAW_LIST = (
    'symbol, "timestamp", open_price, high_price, low_price, close_price, adjusted_close, volume,'
    " dividend_amount, split_coefficient"
)
