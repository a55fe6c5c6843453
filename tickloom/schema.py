"""Declared schemas of the raw, cleansed and fact layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

PRICE_COLUMNS = ["open_price", "high_price", "low_price", "close_price", "adjusted_close"]

RAW_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("timestamp", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in PRICE_COLUMNS]
    + [
        T.StructField("volume", T.LongType()),
        T.StructField("dividend_amount", T.DoubleType()),
        T.StructField("split_coefficient", T.DoubleType()),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

# Fixed order of the 28 fact columns.
FACT_SCHEMA = T.StructType(
    [
        T.StructField("price_id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("trade_date", T.DateType()),
        T.StructField("trade_timestamp", T.TimestampType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in PRICE_COLUMNS]
    + [T.StructField("volume", T.LongType())]
    + [
        T.StructField(c, T.DoubleType())
        for c in [
            "dividend_amount",
            "split_coefficient",
            "daily_return",
            "daily_range",
            "daily_range_pct",
            "volume_change_pct",
            "sma_5",
            "sma_20",
            "sma_50",
            "ema_12",
            "ema_26",
            "volatility_20d",
        ]
    ]
    + [T.StructField(c, T.IntegerType()) for c in ["year", "quarter", "month", "day", "day_of_week"]]
    + [T.StructField("processing_timestamp", T.TimestampType())]
)
FACT_COLUMNS = FACT_SCHEMA.fieldNames()

# Warehouse types that differ from the fact layer.
WAREHOUSE_DECIMALS = {
    T.DecimalType(18, 4): PRICE_COLUMNS
    + ["dividend_amount", "daily_range", "sma_5", "sma_20", "sma_50", "ema_12", "ema_26"],
    T.DecimalType(10, 4): [
        "split_coefficient",
        "daily_return",
        "daily_range_pct",
        "volume_change_pct",
        "volatility_20d",
    ],
}

DIM_SYMBOLS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("company_name", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("market_cap", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)


_DECIMAL_OF = {c: dtype for dtype, columns in WAREHOUSE_DECIMALS.items() for c in columns}

WAREHOUSE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, _DECIMAL_OF.get(f.name, f.dataType))
        for f in FACT_SCHEMA
    ]
)


def select_fact_columns(df: DataFrame) -> DataFrame:
    """Keep the fact columns that exist, in their fixed order."""
    return df.select([c for c in FACT_COLUMNS if c in df.columns])


def to_warehouse_types(df: DataFrame) -> DataFrame:
    """Cast to the warehouse's decimal types; values too large for them become NULL.

    ``decimal_overflows`` counts those values so that a load can report them.
    """
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in _DECIMAL_OF.items() if c in df.columns})


def decimal_overflows(df: DataFrame) -> DataFrame:
    """One row: per decimal column, how many non-null values its type cannot hold."""
    return df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(dtype).isNull()).alias(c)
            for c, dtype in _DECIMAL_OF.items()
            if c in df.columns
        ]
    )
