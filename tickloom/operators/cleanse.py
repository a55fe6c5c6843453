"""Cleansing: from raw bars to standardised, valid, unique bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.functions.scalars import non_negative, standard_symbol, to_number
from tickloom.schema import PRICE_COLUMNS, RAW_SCHEMA

# What stands in for a missing value.
NULL_DEFAULTS = {"volume": 0, "dividend_amount": 0.0, "split_coefficient": 1.0}


def coerce_types(df: DataFrame) -> DataFrame:
    """Raw columns in their declared types; text that does not convert becomes NULL."""
    casts = {
        field.name: F.col(field.name).cast("string")
        if field.dataType.simpleString() == "string"
        else to_number(field.name, field.dataType.simpleString())
        for field in RAW_SCHEMA
        if field.name in df.columns
    }
    return df.withColumns(casts)


def drop_missing_keys(df: DataFrame) -> DataFrame:
    return df.filter(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull())


def standardise_symbols(df: DataFrame) -> DataFrame:
    return df.withColumn("symbol", standard_symbol("symbol"))


def null_negative_prices(df: DataFrame) -> DataFrame:
    return df.withColumns({c: non_negative(c) for c in PRICE_COLUMNS if c in df.columns})


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.na.fill({c: v for c, v in NULL_DEFAULTS.items() if c in df.columns})


def keep_valid_ohlc(df: DataFrame) -> DataFrame:
    """Drop rows whose high is below their low; a missing bound is no violation."""
    high, low = F.col("high_price"), F.col("low_price")
    return df.filter(high.isNull() | low.isNull() | (high >= low))


def deduplicate(df: DataFrame, keys: tuple[str, ...] = ("symbol", "timestamp")) -> DataFrame:
    """Keep one row per key: the first under the order of all other columns.

    The rank limit is applied before the shuffle too, so of any number of copies each map
    task sends on only one.
    """
    order = [c for c in df.columns if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_copy", F.row_number().over(ranked)).filter("_copy <= 1").drop("_copy")


def cleanse(df: DataFrame) -> DataFrame:
    """All cleansing steps, in the order the rules depend on each other."""
    return (
        df.transform(drop_missing_keys)
        .transform(coerce_types)
        .transform(standardise_symbols)
        .transform(null_negative_prices)
        .transform(fill_defaults)
        .transform(keep_valid_ohlc)
        .transform(deduplicate)
    )


def cleansing_report(raw: DataFrame, cleansed: DataFrame) -> DataFrame:
    """One row: rows before and after cleansing, and how many were removed."""
    tagged = raw.select(F.lit(0).alias("after")).unionAll(cleansed.select(F.lit(1).alias("after")))
    counts = tagged.agg(
        F.count_if(F.col("after") == 0).alias("rows_before"),
        F.count_if(F.col("after") == 1).alias("rows_after"),
    )
    return counts.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
