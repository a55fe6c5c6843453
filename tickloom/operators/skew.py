"""Symbol skew: distribution, report, hot symbols, and salted aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SKEW_RATIO = 3.0
HOT_FACTOR = 2
SALT_BUCKETS = 10


def symbol_counts(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    return df.groupBy(symbol).agg(F.count("*").alias("record_count"))


def symbol_distribution(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Rows per symbol, largest first."""
    return symbol_counts(df, symbol).orderBy(F.desc("record_count"), symbol)


def skew_report(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """One row: number of symbols, largest, smallest and (whole-number) mean count, ratio."""
    largest, smallest = F.max("record_count"), F.min("record_count")
    return symbol_counts(df, symbol).agg(
        F.count("*").alias("total_symbols"),
        largest.alias("max_records"),
        smallest.alias("min_records"),
        F.call_function("div", F.sum("record_count"), F.count("*")).alias("avg_records"),
        F.when(smallest > 0, largest / smallest).otherwise(F.lit(1.0)).alias("skew_ratio"),
    )


def hot_symbols(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Symbols with more than twice the mean count.

    Fewer than half of all symbols can be hot; the mean enters the filter as a scalar
    sub-query, so neither the counts nor the hot symbols pass through the driver.
    """
    counts = symbol_counts(df, symbol)
    mean = counts.select(F.call_function("div", F.sum("record_count"), F.count("*")))
    return counts.filter(F.col("record_count") > mean.scalar() * HOT_FACTOR)


def skew_verdict(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """The skew report with the number of hot symbols and whether the data counts as skewed."""
    hot = hot_symbols(df, symbol).select(F.count("*"))
    return (
        skew_report(df, symbol)
        .withColumn("hot_symbols", hot.scalar())
        .withColumn(
            "is_skewed", (F.col("skew_ratio") > SKEW_RATIO) & (F.col("hot_symbols") > 0)
        )
    )


def with_salted_key(
    df: DataFrame, row_id: Column, symbol: str = "symbol", buckets: int = SALT_BUCKETS
) -> DataFrame:
    """Add ``partition_salt``: ``symbol_<0..buckets-1>`` for hot symbols, else the symbol.

    The salt is a function of the row, so a recomputed task salts its rows alike. The join
    with the hot symbols is left to adaptive execution, which broadcasts them only if they
    are small at run time and splits the hot partitions otherwise.
    """
    hot = hot_symbols(df, symbol).select(symbol, F.lit(True).alias("_hot"))
    salted = F.concat_ws("_", F.col(symbol), F.pmod(row_id, F.lit(buckets)).cast("string"))
    return (
        df.join(hot, symbol, "left")
        .withColumn("partition_salt", F.when(F.col("_hot"), salted).otherwise(F.col(symbol)))
        .drop("_hot")
    )


def salted_totals(
    df: DataFrame, value: str, symbol: str = "symbol", buckets: int = SALT_BUCKETS
) -> DataFrame:
    """Per symbol: rows, sum, least, greatest and number of different values, in two stages.

    Different values cannot be combined before the shuffle when nearly all differ, so the
    rows of a hot symbol would meet in one task. Here the value itself takes part in the
    key: equal values meet, and a symbol spreads over all tasks. The sum of whole numbers is a
    decimal, which no group overflows.
    """
    whole = df.schema[value].dataType.typeName() in ("byte", "short", "integer", "long")
    exact = F.col(value).cast("decimal(19,0)") * F.col("_n").cast("decimal(18,0)") if whole else F.col(value) * F.col("_n")
    salt = F.pmod(F.xxhash64(value), F.lit(buckets))
    per_value = df.groupBy(symbol, value).agg(F.count("*").alias("_n"))
    per_salt = per_value.groupBy(symbol, salt.alias("_salt")).agg(
        F.sum("_n").alias("_n"),
        F.sum(exact.cast("decimal(38,0)") if whole else exact).alias("_sum"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
        F.count(value).alias("_distinct"),
    )
    return per_salt.groupBy(symbol).agg(
        F.sum("_n").alias("record_count"),
        F.sum("_sum").alias("total"),
        F.min("_min").alias("least"),
        F.max("_max").alias("greatest"),
        F.sum("_distinct").alias("different_values"),
    )
