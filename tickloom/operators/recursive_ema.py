"""Exponential moving average by its true recursion.

``e[t] = k*x[t] + (1-k)*e[t-1]`` starting at the first price; a missing price carries the
average on while its weight decays. No window frame expresses a recursion, so it runs over
sorted partitions in Arrow batches: a batch is averaged at once for all its series, and only
the state at its end is kept for the next batch.

Series too long for one task are cut into blocks. The recursion is linear in the average it
starts from, so a first pass reduces each block to one row, from which the state at the
start of every block follows exactly, and a second pass continues each block from there.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from tickloom.functions.indicators import DAILY, EMA_PERIODS, Series
from tickloom.operators.long_series import BlockedSeries
from tickloom.session import store

# Send the functions below with the tasks, so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NULLS_SINCE = "_nulls_since"


def _start_column(span: int) -> str:
    return f"_start_{span}"


def with_recursive_ema(
    df: DataFrame,
    spans: tuple[int, ...] = EMA_PERIODS,
    series: Series = DAILY,
    price: str = "close_price",
) -> DataFrame:
    """Add ``ema_recursive_<span>``, four decimals, for series short enough for one task each."""
    averages = {f"ema_recursive_{s}": (s, price) for s in spans}
    return _run(df, averages, series).withColumns({n: F.round(n, 4) for n in averages})


def with_recursive_ema_blocked(
    blocked: BlockedSeries, spans: tuple[int, ...] = EMA_PERIODS, price: str = "close_price"
) -> DataFrame:
    """The same for cut series; cut them with depth 0, since no rows need to be copied."""
    if not blocked.is_cut:
        return with_recursive_ema(blocked.rows, spans, blocked.series, price)
    starts = _block_starts(blocked, spans, price)
    # One row per block of a long series, so its size is bounded by the cuts.
    rows = blocked.rows.drop("_lead_in").join(F.broadcast(starts), list(blocked.series.keys), "left")
    averaged = with_recursive_ema(rows, spans, blocked.series, price)
    return averaged.drop("_block", NULLS_SINCE, *[_start_column(s) for s in spans])


def continue_recursive_ema(
    df: DataFrame,
    states: DataFrame | None = None,
    spans: tuple[int, ...] = EMA_PERIODS,
    series: Series = DAILY,
    price: str = "close_price",
) -> tuple[DataFrame, DataFrame]:
    """The averages of rows that come after those of ``states``, and the states after them.

    A state is one row per series: for each span the unrounded average, and how many rows ago the last
    price was. Rows of increments one after the other get the averages of a single run over
    all. Series that do not occur keep their state. Increments must not reach back in time.
    """
    keys, order = list(series.keys), list(series.order)
    starts = [_start_column(s) for s in spans]
    if states is None:
        fields = [df.schema[k] for k in keys] + [T.StructField(NULLS_SINCE, T.LongType())]
        states = df.sparkSession.createDataFrame([], T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in starts]))
    averages = {f"ema_recursive_{s}": (s, price) for s in spans}
    rows = store(_run(df.join(states, keys, "left"), averages, series), "averaged")
    ordered = Window.partitionBy(*keys).orderBy(*order)
    priced = F.count(price).over(ordered)
    # A row after the last price has seen as many prices as there are.
    ends = rows.withColumn("_seen", priced).groupBy(*keys, "_seen").agg(
        F.count("*").alias("_rows"), F.max(NULLS_SINCE).alias("_before"),
        *[F.max_by(name, F.struct(*order)).alias(c) for name, c in zip(averages, starts)],
    )
    ends = ends.groupBy(*keys).agg(F.max_by(F.struct("_seen", "_rows", "_before", *starts), "_seen").alias("e"))
    # Without a price the rows add to those missing before; else the price's own row is not missing.
    missing = F.when(F.col("e._seen") > 0, F.col("e._rows") - 1).otherwise(F.coalesce("e._before", F.lit(0)) + F.col("e._rows"))
    ended = ends.select(*keys, missing.cast("long").alias(NULLS_SINCE), *[F.col(f"e.{c}").alias(c) for c in starts])
    new_states = states.join(ended.select(*keys), keys, "left_anti").unionByName(ended)
    return rows.drop(NULLS_SINCE, *starts).withColumns({n: F.round(n, 4) for n in averages}), new_states


def _run(
    df: DataFrame, averages: dict[str, tuple[int, str]], series: Series, arranged: bool = False
) -> DataFrame:
    """Add each average, a span over a price column, along the sorted series.

    ``arranged`` says that a window over the series has already brought its rows together.
    """
    keys = list(series.keys)
    schema = T.StructType(df.schema.fields + [T.StructField(n, T.DoubleType()) for n in averages])
    started = NULLS_SINCE in df.columns

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last_key, state = None, {}
        for frame in frames:
            if frame.empty:
                continue
            new = np.ones(len(frame), dtype=bool)
            new[1:] = (frame[keys].iloc[1:].to_numpy() != frame[keys].iloc[:-1].to_numpy()).any(axis=1)
            firsts = np.flatnonzero(new)
            continues = last_key is not None and tuple(frame[keys].iloc[0]) == last_key
            last_key = tuple(frame[keys].iloc[-1])
            for name, (span, price) in averages.items():
                prices = frame[price].to_numpy(dtype="float64")
                start, nulls = np.full(len(firsts), np.nan), np.zeros(len(firsts))
                if started:
                    start = frame[_start_column(span)].to_numpy(dtype="float64")[firsts]
                    nulls = np.nan_to_num(frame[NULLS_SINCE].to_numpy(dtype="float64")[firsts])
                if continues:
                    start[0], nulls[0] = state[name]
                frame[name] = _averages(prices, firsts, start, nulls, span)
                state[name] = _end_state(prices, frame[name].to_numpy(), firsts, nulls)
            yield frame[schema.names]

    together = df if arranged else df.repartition(*keys)
    return together.sortWithinPartitions(*keys, *series.order).mapInPandas(batches, schema)


def _averages(
    prices: np.ndarray, firsts: np.ndarray, start: np.ndarray, nulls: np.ndarray, span: int
) -> np.ndarray:
    """The recursion over the runs of rows beginning at ``firsts``.

    A run that continues an average ``start`` of ``nulls`` rows ago gets it put in front.
    """
    # After this many missing rows the old average weighs less than a double can show.
    limit = math.ceil(-50.0 / math.log(1.0 - 2.0 / (span + 1)))
    lead = np.where(np.isnan(start), 0, 1 + np.minimum(nulls, limit)).astype(np.int64)
    run = np.zeros(len(prices), dtype=np.int64)
    run[firsts[1:]] = 1
    run = np.cumsum(run)
    place = np.arange(len(prices)) + np.cumsum(lead)[run]
    padded = np.full(len(prices) + lead.sum(), np.nan)
    padded[place] = prices
    led = np.flatnonzero(lead)
    padded[place[firsts[led]] - lead[led]] = start[led]
    runs = np.repeat(np.arange(len(firsts)), np.bincount(run, minlength=len(firsts)) + lead)
    return (
        pd.Series(padded).groupby(runs).ewm(span=span, adjust=False).mean().to_numpy()[place]
    )


def _end_state(
    prices: np.ndarray, averages: np.ndarray, firsts: np.ndarray, nulls: np.ndarray
) -> tuple[float, float]:
    """The average after the last row, and how many rows ago its last price was."""
    tail = prices[firsts[-1]:]
    valid = np.flatnonzero(~np.isnan(tail))
    since = len(tail) - 1 - valid[-1] if len(valid) else nulls[-1] + len(tail)
    return float(averages[-1]), float(since)


def _block_starts(blocked: BlockedSeries, spans: Iterable[int], price: str) -> DataFrame:
    """Per block of a cut series the average it starts from and how many nulls ago that was.

    From its first price on, a block turns the average there, ``a``, into ``decay * a + local``.
    ``local`` is the recursion with a first price of 0; ``decay`` is that with a first price of
    1 and all later prices 0.
    """
    keys, order = list(blocked.series.keys), list(blocked.series.order)
    series_keys = keys[:-1]
    ordered = Window.partitionBy(*keys).orderBy(*order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_first = F.col(price).isNotNull() & (F.col("_seen") == 1)
    # Only cut series have a block above 0; the others start from nothing anyway.
    cut = blocked.rows.filter(F.col("_block") > 0).select(*series_keys).distinct()
    rows = (
        blocked.rows.join(F.broadcast(cut), series_keys, "left_semi")
        .select(*dict.fromkeys([*keys, *order, price]))
        .withColumns(
            {
                "_seen": F.count(price).over(ordered),
                "_prices": F.count(price).over(whole),
                "_is_last": F.lead(F.lit(True), 1, False).over(ordered) == F.lit(False),
            }
        )
        .withColumns(
            {
                "_local": F.when(is_first, 0.0).otherwise(F.col(price)),
                "_decay": F.when(is_first, 1.0).when(F.col(price).isNotNull(), 0.0),
            }
        )
    )
    averages = {f"{n}_{s}": (s, f"_{n}") for s in spans for n in ("local", "decay")}
    after = F.count_if(F.col(price).isNull() & (F.col("_seen") == F.col("_prices")))
    summaries = (
        _run(rows, averages, blocked.series, arranged=True)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("_seen") == 0).alias("nulls_before"),
            after.alias("nulls_after"),
            F.max(F.when(is_first, F.col(price))).alias("first_price"),
            *[F.max(F.when(F.col("_is_last"), F.col(n))).alias(n) for n in averages],
        )
    )
    fields = [blocked.rows.schema[k] for k in keys]
    starts = T.StructType(
        fields
        + [T.StructField(NULLS_SINCE, T.LongType())]
        + [T.StructField(_start_column(s), T.DoubleType()) for s in spans]
    )

    def chain(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("_block")
        nulls, average, lines = 0, dict.fromkeys(spans, np.nan), []
        for b in blocks.to_dict("records"):
            lines.append([*[b[k] for k in keys], nulls, *average.values()])
            if np.isnan(b["first_price"]):
                nulls += b["rows"]
                continue
            for s in spans:
                k = 2.0 / (s + 1)
                faded = (1.0 - k) ** (nulls + b["nulls_before"] + 1)
                entered = b["first_price"]
                if not np.isnan(average[s]):
                    entered = (faded * average[s] + k * entered) / (faded + k)
                average[s] = b[f"decay_{s}"] * entered + b[f"local_{s}"]
            nulls = b["nulls_after"]
        return pd.DataFrame(lines, columns=starts.names)

    return summaries.groupBy(*series_keys).applyInPandas(chain, starts)
