"""Queries over the reports, the skew operators, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import order_statistics, reports, skew
from tickloom.plans.derived import (
    customer_orders, event_bars, event_fact, letters, pipeline_metrics, ship_bars, ship_fact,
    supplier_dimension, table,
)
from tickloom.plans.oracle import (
    CUSTOMER_ORDERS, EVENT_BARS, SHIP_BARS, fact, half_up_mean, steps,
)
from tickloom.plans.oracle import letters as sql_letters
from tickloom.plans.registry import checked
from tickloom.session import store

EVENT_FACT = f"{EVENT_BARS}, {fact('event_bars')}"
SHIP_FACT = f"{SHIP_BARS}, {fact('ship_bars')}"
MEAN_CLOSE = f"CAST(sum({steps()}) AS DOUBLE) / 10000 / count(close_price)"


COUNTS = f"{CUSTOMER_ORDERS}, counts AS (SELECT symbol, count(*) AS record_count FROM customer_orders GROUP BY 1)"


@checked("a1_symbol_distribution", f"WITH {COUNTS} SELECT * FROM counts")
def symbol_distribution(spark, sf_dir):
    return skew.symbol_distribution(customer_orders(spark, sf_dir))


@checked(
    "a2_skew_report",
    f"""WITH {COUNTS} SELECT count(*) AS total_symbols, max(record_count) AS max_records,
    min(record_count) AS min_records, CAST(sum(record_count) // count(*) AS BIGINT) AS avg_records,
    CASE WHEN min(record_count) > 0 THEN max(record_count) / CAST(min(record_count) AS DOUBLE) ELSE 1 END
      AS skew_ratio FROM counts""",
)
def skew_report(spark, sf_dir):
    return skew.skew_report(customer_orders(spark, sf_dir))


HOT = f"""{COUNTS}, hot AS (SELECT symbol, record_count FROM counts
  WHERE record_count > 2 * (SELECT sum(record_count) // count(*) FROM counts))"""


@checked("a3_hot_symbols", f"WITH {HOT} SELECT * FROM hot")
def hot_symbols(spark, sf_dir):
    return skew.hot_symbols(customer_orders(spark, sf_dir))


@checked(
    "a3_skew_verdict",
    f"""WITH {HOT} SELECT count(*) AS total_symbols, max(record_count) AS max_records,
    min(record_count) AS min_records, CAST(sum(record_count) // count(*) AS BIGINT) AS avg_records,
    max(record_count) / CAST(min(record_count) AS DOUBLE) AS skew_ratio,
    (SELECT count(*) FROM hot) AS hot_symbols,
    max(record_count) / CAST(min(record_count) AS DOUBLE) > 3 AND (SELECT count(*) FROM hot) > 0 AS is_skewed
    FROM counts""",
)
def skew_verdict(spark, sf_dir):
    return skew.skew_verdict(customer_orders(spark, sf_dir))


@checked(
    "a4_salted_keys",
    f"""WITH {HOT} SELECT CASE WHEN hot.symbol IS NULL THEN o.symbol
      ELSE o.symbol || '_' || CAST(o.o_orderkey % 10 AS VARCHAR) END AS partition_salt, count(*) AS row_count
    FROM customer_orders o LEFT JOIN hot ON o.symbol = hot.symbol GROUP BY 1""",
)
def salted_keys(spark, sf_dir):
    salted = skew.with_salted_key(customer_orders(spark, sf_dir), F.col("o_orderkey"))
    return salted.groupBy("partition_salt").agg(F.count("*").alias("row_count"))


@checked(
    "a4_salted_totals",
    f"""WITH {SHIP_BARS}, priced AS (SELECT {sql_letters("l_suppkey")} AS symbol, steps FROM ship_lines)
    SELECT symbol, count(*) AS record_count, CAST(sum(steps) AS BIGINT) AS total, min(steps) AS least,
    max(steps) AS greatest, count(DISTINCT steps) AS different_values FROM priced GROUP BY 1""",
)
def salted_totals(spark, sf_dir):
    cents = F.floor(F.col("l_extendedprice") * 100.0 + 0.5)
    quantity = F.col("l_quantity").cast("long")
    rows = table(spark, sf_dir, "lineitem").select(
        letters("l_suppkey").alias("symbol"),
        F.call_function("div", cents * 200 + quantity, quantity * 2).alias("steps"),
    )
    return skew.salted_totals(rows, "steps").withColumn("total", F.col("total").cast("long"))


@checked(
    "a5_symbol_summary",
    f"""WITH {EVENT_BARS} SELECT symbol, count(*) AS record_count, min(trade_date) AS earliest_date,
    max(trade_date) AS latest_date, {MEAN_CLOSE} AS avg_close FROM event_bars GROUP BY 1""",
)
def symbol_summary(spark, sf_dir):
    return reports.symbol_summary(event_fact(spark, sf_dir))


@checked(
    "a6_symbol_price_stats",
    f"""WITH {EVENT_BARS} SELECT symbol, count(*) AS record_count,
    {half_up_mean(f"sum({steps()})", "count(close_price)", 2)} AS avg_price,
    round(min(close_price), 2) AS min_price, round(max(close_price), 2) AS max_price
    FROM event_bars GROUP BY 1""",
)
def symbol_price_stats(spark, sf_dir):
    return reports.symbol_price_stats(event_fact(spark, sf_dir))


@checked(
    "a7_symbol_indicator_averages",
    f"""WITH {EVENT_FACT} SELECT symbol, count(*) AS record_count,
    {half_up_mean(f"sum({steps()})", "count(close_price)", 2)} AS avg_price,
    {half_up_mean(f"sum({steps('sma_20')})", "count(sma_20)", 2)} AS avg_sma_20,
    round(avg(daily_return), 4) AS avg_return FROM fact GROUP BY 1""",
)
def symbol_indicator_averages(spark, sf_dir):
    return reports.symbol_indicator_averages(event_fact(spark, sf_dir))


ROLLUP = f"""SELECT symbol, CAST(trade_date AS TIMESTAMP) AS date, {MEAN_CLOSE} AS avg_close,
  CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS record_count"""


@checked("a8_daily_rollup", f"WITH {EVENT_BARS} {ROLLUP} FROM event_bars GROUP BY 1, 2")
def daily_rollup(spark, sf_dir):
    return reports.daily_rollup(event_fact(spark, sf_dir))


@checked(
    "a8_newest_daily_rollup",
    f"WITH {EVENT_BARS} {ROLLUP} FROM event_bars GROUP BY 1, 2 ORDER BY date DESC, symbol LIMIT 10",
)
def newest_daily_rollup(spark, sf_dir):
    return reports.daily_rollup(event_fact(spark, sf_dir), 10)


@checked("a9_records_per_symbol", f"WITH {COUNTS} SELECT * FROM counts")
def records_per_symbol(spark, sf_dir):
    return skew.symbol_counts(customer_orders(spark, sf_dir))


@checked("a10_row_count", f"WITH {SHIP_BARS} SELECT count(*) AS cnt FROM ship_bars")
def table_row_count(spark, sf_dir):
    return reports.row_count(ship_fact(spark, sf_dir))


@checked(
    "a10_row_count_of_date",
    f"WITH {EVENT_BARS} SELECT count(*) AS cnt FROM event_bars WHERE trade_date = DATE '2024-01-15'",
)
def row_count_of_date(spark, sf_dir):
    return reports.row_count(event_fact(spark, sf_dir), "2024-01-15")


@checked(
    "a11_dataset_stats",
    f"""WITH {EVENT_BARS} SELECT count(*) AS total_records, count(DISTINCT symbol) AS unique_symbols,
    min(trade_date) AS min_date, max(trade_date) AS max_date FROM event_bars""",
)
def dataset_stats(spark, sf_dir):
    return reports.dataset_stats(event_fact(spark, sf_dir))


def _described(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count({column}) AS count, round(avg({column}), 6) AS mean,
    round(stddev_samp({column}), 6) AS std, min({column}) AS min, round(quantile_cont({column}, 0.25), 8) AS p25,
    round(quantile_cont({column}, 0.5), 8) AS p50, round(quantile_cont({column}, 0.75), 8) AS p75,
    max({column}) AS max FROM fact"""


DESCRIBED = ["sma_5", "sma_20", "ema_12", "volatility_20d"]


@checked("a12_indicator_describe", f"WITH {SHIP_FACT} " + " UNION ALL ".join(map(_described, DESCRIBED)))
def indicator_describe(spark, sf_dir):
    rows = store(ship_fact(spark, sf_dir).select(DESCRIBED), "indicators")
    described = order_statistics.describe(rows, DESCRIBED)
    return described.withColumns(
        {c: F.round(c, 6) for c in ("mean", "std")} | {c: F.round(c, 8) for c in ("p25", "p50", "p75")}
    )


@checked(
    "a13_daily_ingested",
    "SELECT date_trunc('day', ts)::TIMESTAMP AS time, count(*) AS record_count FROM events GROUP BY 1",
)
def daily_ingested(spark, sf_dir):
    return reports.daily_ingested(table(spark, sf_dir, "events"), "ts")


@checked(
    "a14_success_rate",
    "SELECT 'success_rate' AS metric_name, round(avg(value), 6) AS avg_value FROM events WHERE event_type = 'error'",
)
def success_rate(spark, sf_dir):
    rate = reports.mean_metric(pipeline_metrics(spark, sf_dir))
    return rate.withColumn("avg_value", F.round("avg_value", 6))


@checked(
    "a15_ingest_summary",
    """SELECT CAST(o_orderdate AS DATE) AS batch, count(*) AS total,
    count(*) FILTER (o_orderstatus = 'F') AS successful, count(*) FILTER (o_orderstatus <> 'F') AS failed,
    bool_or(o_orderstatus = 'F') AS usable FROM orders GROUP BY 1""",
)
def ingest_summary(spark, sf_dir):
    attempts = table(spark, sf_dir, "orders").withColumn("batch", F.to_date("o_orderdate"))
    return reports.ingest_summary(attempts, "batch", F.col("o_orderstatus") == "F")


LATEST = "SELECT symbol, trade_date, close_price, sma_20, daily_return FROM fact"


@checked("t1_latest_prices", f"WITH {EVENT_FACT} {LATEST} ORDER BY trade_date DESC, symbol LIMIT 10")
def latest_prices(spark, sf_dir):
    return reports.latest_prices(event_fact(spark, sf_dir))


VOLATILE = "symbol, trade_date, volatility_20d, close_price"


@checked(
    "t2_highest_volatility",
    f"""WITH {EVENT_FACT} SELECT {VOLATILE} FROM fact WHERE volatility_20d > 0.30
    ORDER BY volatility_20d DESC, symbol, trade_date LIMIT 20""",
)
def highest_volatility(spark, sf_dir):
    return reports.highest_volatility(event_fact(spark, sf_dir))


@checked(
    "t3_trend_listing",
    f"""WITH {SHIP_FACT} SELECT symbol, trade_date, close_price, sma_50, volatility_20d,
    CASE WHEN close_price > sma_50 THEN 'BULLISH' ELSE 'BEARISH' END AS trend
    FROM fact WHERE trade_date >= DATE '1998-02-01'""",
)
def trend_listing(spark, sf_dir):
    return reports.trend_listing(ship_fact(spark, sf_dir), "1998-02-01")


@checked(
    "j1_semi_and_anti_join",
    """SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS matched
    FROM orders""",
)
def semi_and_anti_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    on = orders["o_orderkey"] == returned["l_orderkey"]
    matched = orders.join(returned, on, "left_semi").select("o_orderkey", F.lit(True).alias("matched"))
    others = orders.join(returned, on, "left_anti").select("o_orderkey", F.lit(False).alias("matched"))
    return matched.unionByName(others)


@checked(
    "j2_symbol_details",
    f"""WITH {SHIP_BARS} SELECT b.symbol, b.trade_date, b.close_price, s.s_name AS company_name,
    r.r_name AS sector, n.n_name AS industry, 'LOCAL' AS exchange,
    CAST(floor(s.s_acctbal * 100 + 0.5) AS BIGINT) AS market_cap
    FROM ship_bars b LEFT JOIN supplier s ON b.symbol = {sql_letters("s.s_suppkey")}
    LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
)
def symbol_details(spark, sf_dir):
    rows = ship_fact(spark, sf_dir).select("symbol", "trade_date", "close_price")
    return reports.with_symbol_details(rows, supplier_dimension(spark, sf_dir))


@checked(
    "j3_bag_union",
    f"""WITH {EVENT_BARS}, {SHIP_BARS}, both_bars AS (SELECT symbol, volume FROM event_bars
    UNION ALL SELECT symbol, volume FROM ship_bars)
    SELECT symbol, count(*) AS record_count, CAST(sum(volume) AS BIGINT) AS volume FROM both_bars GROUP BY 1""",
)
def bag_union(spark, sf_dir):
    both = event_bars(spark, sf_dir).unionByName(ship_bars(spark, sf_dir))
    return both.groupBy("symbol").agg(
        F.count("*").alias("record_count"), F.sum("volume").alias("volume")
    )


@checked("j4_distinct_symbols", f"WITH {CUSTOMER_ORDERS} SELECT DISTINCT symbol FROM customer_orders")
def distinct_symbols(spark, sf_dir):
    return reports.symbols(customer_orders(spark, sf_dir))
