"""Exact quartiles and a describe table without sorting or collecting a column.

Each pass counts the values of every open interval in a fixed number of equal buckets, in one
aggregation that combines before the shuffle. Running sums over the buckets, made in Spark, tell
which of them holds a wanted rank; it becomes the next interval. A few passes narrow any range
down to one value; the driver sees one row per wanted rank and pass.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

# Two passes tell apart a quarter of a billion evenly spread values.
BUCKETS = 16_384


@dataclass(frozen=True)
class _Interval:
    column: str
    low: float
    high: float


def _bounds(df: DataFrame, columns: list[str], **others: Callable) -> dict[str, dict]:
    """Per column its count, least and greatest value, and what else is asked for, in one pass."""
    measures = {"count": F.count, "min": F.min, "max": F.max, **others}
    row = df.agg(
        *[
            measure(F.col(c).cast("double")).alias(f"{name}_{i}")
            for i, c in enumerate(columns)
            for name, measure in measures.items()
        ]
    ).first()
    return {c: {name: row[f"{name}_{i}"] for name in measures} for i, c in enumerate(columns)}


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float]
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighbours; NULLs are left out.

    The table is read once per pass, so pass a stored one.
    """
    return _quantiles(df, _bounds(df, columns), probabilities)


# Infinities count as the greatest finite numbers, so that every interval has a width.
LARGEST = sys.float_info.max
INFINITIES = {LARGEST: math.inf, -LARGEST: -math.inf}


def _finite(value: float) -> float:
    return max(-LARGEST, min(LARGEST, value))


def _quantiles(
    df: DataFrame, bounds: dict[str, dict], probabilities: list[float]
) -> dict[str, list[float | None]]:
    ranks: dict[tuple[str, int], tuple[_Interval, int]] = {}
    for c, known in bounds.items():
        n = known["count"]
        for p in probabilities if n else []:
            for rank in {math.floor((n - 1) * p), math.ceil((n - 1) * p)}:
                ranks[c, rank] = (_Interval(c, _finite(known["min"]), _finite(known["max"])), rank)
    values = {key: INFINITIES.get(v, v) for key, v in _select_ranks(df, ranks).items()}

    result: dict[str, list[float | None]] = {}
    for c, known in bounds.items():
        n = known["count"]
        result[c] = []
        for p in probabilities:
            if not n:
                result[c].append(None)
                continue
            at = (n - 1) * p
            low, high = values[c, math.floor(at)], values[c, math.ceil(at)]
            result[c].append(low if low == high else low + (high - low) * (at - math.floor(at)))
    return result


def _select_ranks(df, ranks):
    """The value at each (column, rank); the state is the interval it lies in and the rank there."""
    found: dict[tuple[str, int], float] = {}
    while ranks:
        for key, (interval, _) in list(ranks.items()):
            if interval.low == interval.high:
                found[key] = interval.low
                del ranks[key]
        if not ranks:
            break
        intervals = sorted({iv for iv, _ in ranks.values()}, key=lambda iv: (iv.column, iv.low, iv.high))
        places = {iv: i for i, iv in enumerate(intervals)}
        narrowed = _narrow(df, intervals, sorted({(places[iv], rank) for iv, rank in ranks.values()}))
        # Ranks of one column that meet in an interval are told apart by their own place in it.
        for key, (iv, rank) in list(ranks.items()):
            low, high, inside = narrowed[places[iv], rank]
            ranks[key] = (_Interval(iv.column, low, high), inside)
    return found


def _narrow(df, intervals, wanted):
    """For each (interval, rank) the bucket that holds the rank: least value, greatest value, rank inside."""
    entries = []
    for i, iv in enumerate(intervals):
        value = F.col(iv.column).cast("double")
        value = F.when(value > LARGEST, LARGEST).when(value < -LARGEST, -LARGEST).otherwise(value)
        # Halved, so that the difference cannot overflow.
        share = (value / 2 - iv.low / 2) / (iv.high / 2 - iv.low / 2)
        bucket = F.least(F.lit(BUCKETS - 1), F.floor(share * BUCKETS).cast("int"))
        entries.append(
            F.when(
                value.between(iv.low, iv.high),
                F.struct(F.lit(i).alias("i"), bucket.alias("bucket"), value.alias("value")),
            )
        )
    columns = sorted({iv.column for iv in intervals})
    counted = (
        df.select(*columns)
        .select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .groupBy("e.i", "e.bucket")
        .agg(F.min("e.value").alias("low"), F.max("e.value").alias("high"), F.count("*").alias("n"))
    )
    # At most BUCKETS rows per interval, so this window is short however long the column is.
    along = Window.partitionBy("i").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.withColumn("through", F.sum("n").over(along))
    sought = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(rank).cast("long").alias("rank")) for i, rank in wanted])
    inside = F.filter(
        sought, lambda w: (w["i"] == F.col("i")) & (w["rank"] >= F.col("through") - F.col("n")) & (w["rank"] < F.col("through"))
    )
    held = summed.select("i", "low", "high", (F.col("through") - F.col("n")).alias("below"), F.explode(inside).alias("w"))
    # One row per wanted rank.
    return {(r["i"], r["w"]["rank"]): (r["low"], r["high"], r["w"]["rank"] - r["below"]) for r in held.collect()}


DESCRIPTION = (
    "column_name string, count long, mean double, std double, min double,"
    " p25 double, p50 double, p75 double, max double"
)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles and max."""
    known = _bounds(df, columns, mean=F.avg, std=F.stddev_samp)
    quartiles = _quantiles(df, known, [0.25, 0.5, 0.75])
    lines = [
        (c, k["count"], k["mean"], k["std"], k["min"], *quartiles[c], k["max"]) for c, k in known.items()
    ]
    return df.sparkSession.createDataFrame(lines, DESCRIPTION)
