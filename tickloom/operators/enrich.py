"""Enrichment: dates, indicators, date dimensions and metadata."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions import indicators as ind
from tickloom.functions.indicators import Series
from tickloom.functions.scalars import day_of_week, parseable_timestamp, surrogate_key
from tickloom.schema import select_fact_columns

# After de-duplication (symbol, timestamp) is unique, so this order has no ties.
BAR_SERIES = Series(("symbol",), ("trade_date", "trade_timestamp", "timestamp"))

# Rows before the current one that an indicator may look at.
INDICATOR_DEPTH = max(*ind.SMA_PERIODS, *ind.EMA_PERIODS, ind.VOLATILITY_WINDOW + 1) - 1


def standardise_dates(df: DataFrame) -> DataFrame:
    """Add trade_date and trade_timestamp; rows whose date does not parse are dropped.

    Dates parse by the same formats that the quality rule for them accepts.
    """
    dated = df.withColumn("trade_timestamp", parseable_timestamp("timestamp"))
    return dated.withColumn("trade_date", F.to_date("trade_timestamp")).filter(F.col("trade_date").isNotNull())


def with_date_dimensions(df: DataFrame, week_start: str = "sunday") -> DataFrame:
    return df.withColumns(
        {
            "year": F.year("trade_date"),
            "quarter": F.quarter("trade_date"),
            "month": F.month("trade_date"),
            "day": F.dayofmonth("trade_date"),
            "day_of_week": day_of_week("trade_date", week_start),
        }
    )


def with_metadata(df: DataFrame, run_time: datetime | Column | None = None) -> DataFrame:
    """Add the key and the time of the run, the same for every row of the run."""
    if run_time is None:
        run_time = datetime.now()
    stamp = run_time if isinstance(run_time, Column) else F.lit(run_time)
    return df.withColumns(
        {"price_id": surrogate_key(), "processing_timestamp": stamp.cast("timestamp")}
    )


def enrich(
    cleansed: DataFrame,
    run_time: datetime | Column | None = None,
    series: Series = BAR_SERIES,
    week_start: str = "sunday",
) -> DataFrame:
    """Cleansed bars to fact rows, for series short enough for one task each."""
    return finish(ind.with_indicators(standardise_dates(cleansed), series), run_time, week_start)


def finish(
    rows: DataFrame,
    run_time: datetime | Column | None = None,
    week_start: str = "sunday",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows with indicators to fact rows: date dimensions, metadata, the fixed columns and those to ``keep``."""
    full = with_metadata(with_date_dimensions(rows, week_start), run_time)
    return full.select(*select_fact_columns(full).columns, *keep)
