"""Window functions over series too long for one task.

A window needs its whole series in one task. When a few symbols hold a large part of all
rows, those series are cut into blocks of about equal size along their order. Each block
also gets a copy of the rows just before it, as many as the indicators look back, so every
row sees the same window as in the uncut series. Salting cannot do this: it would tear a
window apart.

Sizes: at most ``max_blocks`` cuts and ``depth * max_blocks`` copied rows over all symbols,
whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.indicators import Series
from tickloom.session import store

ROWS_PER_BLOCK = 5_000_000
MAX_BLOCKS = 10_000
MICROS_PER_DAY = 86_400_000_000


@dataclass(frozen=True)
class BlockedSeries:
    """Rows with ``_block`` and ``_lead_in``, and the series that windows over them use."""

    rows: DataFrame
    series: Series
    is_cut: bool

    def apply(self, indicators: Callable[[DataFrame, Series], DataFrame]) -> DataFrame:
        """Compute the indicators, then drop the copied rows."""
        if not self.is_cut:
            return indicators(self.rows, self.series)
        return indicators(self.rows, self.series).filter(~F.col("_lead_in")).drop("_block", "_lead_in")


def bar_position() -> Column:
    """Where a bar lies in time, as one number that never falls along (trade_date, trade_timestamp)."""
    midnight = F.unix_micros(F.col("trade_date").cast("timestamp"))
    into_day = F.coalesce(F.unix_micros("trade_timestamp") - midnight, F.lit(0))
    within = F.greatest(F.lit(0), F.least(into_day, F.lit(MICROS_PER_DAY - 1)))
    return F.unix_date("trade_date").cast("long") * MICROS_PER_DAY + within


def cut_long_series(
    df: DataFrame,
    series: Series,
    depth: int,
    position: Column | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
    max_blocks: int = MAX_BLOCKS,
) -> BlockedSeries:
    """Cut the series longer than ``rows_per_block``; leave the rest as they are.

    ``df`` is read up to four times, so pass a stored table. If no series is too long, only
    the count over the key columns is spent. ``position`` is a whole number that does not
    fall along the order of the series; rows of the same position stay in one block.
    """
    position = bar_position() if position is None else position
    keys = list(series.keys)
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    total, longest = counts.agg(F.sum("_n"), F.max("_n")).first()
    if not total or longest <= rows_per_block:
        return BlockedSeries(df, series, False)

    size = max(rows_per_block, math.ceil(total / max_blocks))
    if longest <= size:
        return BlockedSeries(df, series, False)
    cuts = _cut_points(df, counts.filter(F.col("_n") > size), keys, position, size, longest)

    # At most total / size long series and as many cuts: a bounded broadcast.
    blocked = (
        df.withColumn("_position", position)
        .join(F.broadcast(cuts), keys, "left")
        .withColumn("_block", _cuts_below(F.col("_cuts"), F.col("_position"), longest // size + 1))
        .drop("_position")
    )
    body = blocked.drop("_cuts").withColumn("_lead_in", F.lit(False))
    series = replace(series, keys=(*series.keys, "_block"))
    if depth == 0:
        return BlockedSeries(body, series, True)
    long_rows = blocked.filter(F.col("_cuts").isNotNull()).drop("_cuts")
    lead_in = _lead_in_rows(long_rows, keys, series.order, depth)
    return BlockedSeries(body.unionByName(lead_in), series, True)


def _cut_points(
    df: DataFrame, long: DataFrame, keys: list[str], position: Column, size: int, longest: int
) -> DataFrame:
    """Per long series the positions that split it into blocks of about ``size`` rows."""
    finest = math.ceil(longest / size)
    steps = [i / finest for i in range(1, finest)]
    quantiles = F.percentile_approx("_position", steps, max(10 * finest, 1000))
    long = long.withColumn("_blocks", F.ceil(F.col("_n") / F.lit(size)).cast("int"))
    wanted = F.transform(
        F.sequence(F.lit(1), F.col("_blocks") - 1),
        lambda i: F.element_at("_finest", F.greatest(F.lit(1), F.round(i * finest / F.col("_blocks")).cast("int"))),
    )
    sketched = (
        df.select(*keys, position.alias("_position"))
        .join(F.broadcast(long.select(*keys, "_blocks")), keys)
        .groupBy(*keys, "_blocks")
        .agg(quantiles.alias("_finest"))
    )
    cuts = sketched.select(*keys, F.array_sort(F.array_distinct(wanted)).alias("_cuts"))
    return store(cuts, "series-cuts")


def _cuts_below(cuts: Column, position: Column, most_cuts: int) -> Column:
    """How many cuts lie below the position, by binary search; 0 for an uncut series."""
    strides = [F.lit(1 << b) for b in reversed(range(most_cuts.bit_length()))]
    found = F.aggregate(
        F.array(*strides),
        F.lit(0),
        lambda below, stride: F.when(
            F.get(cuts, below + stride - 1) < position, below + stride
        ).otherwise(below),
    )
    return F.when(cuts.isNull(), F.lit(0)).otherwise(found)


def _lead_in_rows(
    blocked: DataFrame, keys: list[str], order: tuple[str, ...], depth: int
) -> DataFrame:
    """For every block the ``depth`` rows before it, however many blocks they come from."""
    latest_first = Window.partitionBy(*keys, "_block").orderBy(*[F.col(c).desc() for c in order])
    tails = store(
        blocked.withColumn("_from_end", F.row_number().over(latest_first)).filter(
            F.col("_from_end") <= depth
        ),
        "series-tails",
    )
    blocks_in_order = Window.partitionBy(*keys).orderBy("_block")
    following = (
        tails.groupBy(*keys, "_block")
        .agg(F.count("*").alias("_kept"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_kept").over(blocks_in_order.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .withColumn(
            "_later",
            F.collect_list(F.struct(F.col("_block").alias("block"), F.col("_before").alias("before"))).over(
                blocks_in_order.rowsBetween(1, depth)
            ),
        )
    )
    place = F.col("_before") + F.col("_kept") - F.col("_from_end") + 1
    return (
        tails.join(following, [*keys, "_block"])
        .withColumn("_place", place)
        .withColumn(
            "_target", F.explode(F.filter("_later", lambda b: b["before"] < F.col("_place") + depth))
        )
        .withColumns({"_block": F.col("_target.block"), "_lead_in": F.lit(True)})
        .drop("_from_end", "_kept", "_before", "_later", "_place", "_target")
    )
