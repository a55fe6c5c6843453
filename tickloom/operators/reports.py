"""Analytic reports over fact tables: summaries, rollups, listings, top-k and the dimension join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.scalars import mean_price, rounded_mean_price

def symbol_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy("symbol").agg(
        F.count("*").alias("record_count"),
        F.min("trade_date").alias("earliest_date"),
        F.max("trade_date").alias("latest_date"),
        mean_price("close_price").alias("avg_close"),
    )


def symbol_price_stats(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("symbol")
        .agg(
            F.count("*").alias("record_count"),
            rounded_mean_price("close_price", 2).alias("avg_price"),
            F.round(F.min("close_price"), 2).alias("min_price"),
            F.round(F.max("close_price"), 2).alias("max_price"),
        )
        .orderBy("symbol")
    )


def symbol_indicator_averages(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("symbol")
        .agg(
            F.count("*").alias("record_count"),
            rounded_mean_price("close_price", 2).alias("avg_price"),
            rounded_mean_price("sma_20", 2).alias("avg_sma_20"),
            F.round(F.avg("daily_return"), 4).alias("avg_return"),
        )
        .orderBy("symbol")
    )


def daily_rollup(fact: DataFrame, limit: int | None = None) -> DataFrame:
    """Mean close, volume and rows by symbol and day, newest day first."""
    rolled = (
        fact.groupBy("symbol", F.date_trunc("day", "trade_date").alias("date"))
        .agg(
            mean_price("close_price").alias("avg_close"),
            F.sum("volume").alias("total_volume"),
            F.count("*").alias("record_count"),
        )
        .orderBy(F.desc("date"), "symbol")
    )
    return rolled if limit is None else rolled.limit(limit)


def row_count(table: DataFrame, trade_date: str | None = None) -> DataFrame:
    """Rows of a table, or of one trade date."""
    if trade_date is not None:
        table = table.filter(F.col("trade_date") == F.to_date(F.lit(trade_date)))
    return table.agg(F.count("*").alias("cnt"))


def dataset_stats(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("symbol").alias("unique_symbols"),
        F.min("trade_date").alias("min_date"),
        F.max("trade_date").alias("max_date"),
    )


def daily_ingested(table: DataFrame, created_at: str = "created_at") -> DataFrame:
    day = F.date_trunc("day", created_at).alias("time")
    return table.groupBy(day).agg(F.count("*").alias("record_count")).orderBy("time")


def mean_metric(metrics: DataFrame, name: str = "success_rate") -> DataFrame:
    """Mean of one metric of a (metric_name, metric_value, timestamp) table."""
    return (
        metrics.filter(F.col("metric_name") == name)
        .groupBy("metric_name")
        .agg(F.avg("metric_value").alias("avg_value"))
    )


def ingest_summary(attempts: DataFrame, batch: str, succeeded: Column) -> DataFrame:
    """Per batch of fetch attempts: total, successful, failed, and whether any succeeded."""
    return attempts.groupBy(batch).agg(
        F.count("*").alias("total"),
        F.count_if(succeeded).alias("successful"),
        F.count_if(~succeeded).alias("failed"),
        F.coalesce(F.some(succeeded), F.lit(False)).alias("usable"),
    )


def require_usable(summary: DataFrame) -> None:
    """Raise if any batch has no successful attempt."""
    dead = summary.filter(~F.col("usable")).limit(20).collect()
    if dead:
        raise RuntimeError(f"no successful attempt in: {[row[0] for row in dead]}")


LATEST_COLUMNS = ["symbol", "trade_date", "close_price", "sma_20", "daily_return"]


def latest_prices(fact: DataFrame, limit: int = 10, columns: list[str] | None = None) -> DataFrame:
    """The newest rows, by symbol within a date."""
    return fact.select(columns or LATEST_COLUMNS).orderBy(F.desc("trade_date"), "symbol").limit(limit)


def highest_volatility(fact: DataFrame, above: float = 0.30, limit: int = 20) -> DataFrame:
    return (
        fact.filter(F.col("volatility_20d") > above)
        .select("symbol", "trade_date", "volatility_20d", "close_price")
        .orderBy(F.desc("volatility_20d"), "symbol", "trade_date")
        .limit(limit)
    )


def trend() -> Column:
    """BULLISH above the 50-row mean, else BEARISH, also where there is no mean."""
    return F.when(F.col("close_price") > F.col("sma_50"), "BULLISH").otherwise("BEARISH")


def trend_listing(fact: DataFrame, since: str) -> DataFrame:
    return (
        fact.filter(F.col("trade_date") >= F.to_date(F.lit(since)))
        .select(
            "symbol", "trade_date", "close_price", "sma_50", "volatility_20d", trend().alias("trend")
        )
        .orderBy(F.desc("trade_date"), "symbol")
    )


def with_symbol_details(fact: DataFrame, dim_symbols: DataFrame) -> DataFrame:
    """Left join with the symbol dimension.

    No broadcast hint: Spark broadcasts the dimension when its size, known or measured while
    running, is under the threshold; beyond it, the skew join splits a hot symbol's rows.
    """
    return fact.join(dim_symbols.drop("created_at", "updated_at"), "symbol", "left")


def symbols(table: DataFrame) -> DataFrame:
    return table.select("symbol").distinct()
