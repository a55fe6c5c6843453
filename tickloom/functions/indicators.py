"""Technical indicators as column expressions over ordered series.

All indicators of one series share a partitioning and an ordering, so Spark plans a single
exchange and a single sort for any number of them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tickloom.functions.scalars import (
    PRICE_SCALE,
    half_up_ratio,
    known_price,
    mean_of_steps,
    pct_change,
    price_steps,
    whole_steps,
)

SMA_PERIODS = (5, 20, 50)
EMA_PERIODS = (12, 26)
VOLATILITY_WINDOW = 20
# Type of summed price steps.
STEP_SUM = "decimal(32,4)"


@dataclass(frozen=True)
class Series:
    """What identifies a series and what orders it.

    A task holds one whole series, so its length must be bounded: daily bars are bounded by
    the calendar (about 250 a year). Intraday series are cut into blocks first, see
    ``tickloom.operators.long_series``.
    """

    keys: tuple[str, ...] = ("symbol",)
    order: tuple[str, ...] = ("trade_date",)

    def ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def last(self, n: int) -> WindowSpec:
        return self.ordered().rowsBetween(1 - n, Window.currentRow)


DAILY = Series()


Parts = list[dict[str, Column]]


def rolling_sums(
    periods: Iterable[int], series: Series = DAILY, price: str = "close_price"
) -> Parts:
    """Per period the summed price steps, the numbers of steps and of prices, and the mean in doubles, of its last rows.

    They are columns of their own because an indicator uses each several times, and Spark
    evaluates a window function once per mention. Each entry of the list needs those before it.

    A frame that slides is summed anew for every row, with all that its sum is made of. Steps are exact,
    so their sums and counts are differences of those from the start of the series, whose frame only
    grows; only the doubles are summed in sliding frames, as plain columns. Whole steps are summed
    apart from finer ones, as long integers, which are many times faster than decimals.
    """
    periods = list(periods)
    whole = whole_steps(price)
    of_row = {"_known": known_price(price), "_whole": whole, "_fine": F.when(whole.isNull(), price_steps(price))}
    so_far = series.ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grown = {f"_n{c}": F.count(c).over(so_far) for c in of_row}
    grown |= {f"_sum{c}": F.sum(c).over(so_far) for c in ("_whole", "_fine")}
    before, differences = {}, {}
    for n in periods:
        before |= {f"{c}_before_{n}": F.lag(c, n).over(series.ordered()) for c in grown}
        before[f"_mean_{n}"] = F.avg("_known").over(series.last(n))
        differences |= {f"{c}_{n}": _since(c, n) for c in grown if c != "_sum_fine"}
    return [of_row, grown, before, differences]


def _since(sums: str, n: int) -> Column:
    """What the last ``n`` rows add to a sum from the start of the series; 0 for no values."""
    zero = F.lit(0).cast(STEP_SUM) if sums == "_sum_fine" else F.lit(0).cast("long")
    return F.coalesce(F.col(sums), zero) - F.coalesce(F.col(f"{sums}_before_{n}"), zero)


def _total_steps(n: int) -> Column:
    """The steps of the last ``n`` rows, if some are no whole number."""
    return (_since("_sum_fine", n) + F.col(f"_sum_whole_{n}")).cast(STEP_SUM)


def previous_values(series: Series = DAILY) -> dict[str, Column]:
    return {f"_previous_{c}": F.lag(c, 1).over(series.ordered()) for c in ("close_price", "volume")}


def daily_range() -> Column:
    return F.col("high_price") - F.col("low_price")


def daily_range_pct() -> Column:
    close = F.col("close_price")
    return F.when(close > 0, (F.col("high_price") - F.col("low_price")) / close * 100.0)


def daily_return() -> Column:
    """Change of the close against ``_previous_close_price`` in percent."""
    return pct_change(F.col("close_price"), F.col("_previous_close_price"))


def volume_change_pct() -> Column:
    """Change of the volume against ``_previous_volume`` in percent."""
    previous = F.col("_previous_volume")
    change = (F.col("volume") - previous).cast("double")
    return F.when(previous > 0, change / previous.cast("double") * 100.0)


def log_return() -> Column:
    """Logarithm of the close over ``_previous_close_price``, where both are positive."""
    close, previous = F.col("close_price"), F.col("_previous_close_price")
    return F.when((previous > 0) & (close > 0), F.log(close / previous))


def _by_precision(n: int, whole: Column, fine: Column, rough: Column) -> Column:
    """The result from whole steps if all prices of the window have them, from finer ones if all are exact, else in doubles."""
    count, wholes = F.col(f"_n_known_{n}"), F.col(f"_n_whole_{n}")
    return F.when(wholes == count, whole).when(wholes + F.col(f"_n_fine_{n}") == count, fine).otherwise(rough)


def sma(n: int, min_periods: int = 1) -> Column:
    """Mean of the last ``n`` rows from ``rolling_sums``; NULL below ``min_periods`` prices."""
    count = F.col(f"_n_known_{n}")
    whole, fine = mean_of_steps(F.col(f"_sum_whole_{n}"), count), mean_of_steps(_total_steps(n), count)
    return F.when(count >= min_periods, _by_precision(n, whole, fine, F.round(f"_mean_{n}", 4)))


def ema_simple(n: int) -> Column:
    """``mean * k + price * (1 - k)`` with ``k = 2 / (n + 1)`` and the mean of the last ``n`` rows.

    Brought to one fraction of exact numbers, so that rounding sees the exact value; in doubles
    if a price of the window has no exact steps.
    """
    count, known = F.col(f"_n_known_{n}"), F.col("_known")

    def exact(total: Column, steps: Column) -> Column:
        return half_up_ratio(total * 2 + count * steps * (n - 1), count * (n + 1)) / float(PRICE_SCALE)

    k = 2 / (n + 1)
    whole = exact(F.col(f"_sum_whole_{n}"), F.col("_whole"))
    fine = exact(_total_steps(n), F.coalesce(F.col("_fine"), F.col("_whole").cast("decimal(22,4)")))
    return F.when(known.isNotNull(), _by_precision(n, whole, fine, F.round(F.col(f"_mean_{n}") * k + known * (1 - k), 4)))


def derived_metrics() -> dict[str, Column]:
    return {
        "daily_range": daily_range(),
        "daily_range_pct": daily_range_pct(),
        "daily_return": daily_return(),
        "volume_change_pct": volume_change_pct(),
    }


def _from_parts(df: DataFrame, parts: Parts, results: dict[str, Column]) -> DataFrame:
    return reduce(DataFrame.withColumns, parts, df).withColumns(results).drop(*[c for part in parts for c in part])


def with_derived_metrics(df: DataFrame, series: Series = DAILY) -> DataFrame:
    return _from_parts(df, [previous_values(series)], derived_metrics())


def with_log_returns(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """Add ``log_return`` and ``change``, the fraction of the previous close."""
    results = {"log_return": log_return(), "change": daily_return() / 100.0}
    return _from_parts(df, [previous_values(series)], results)


def with_moving_averages(
    df: DataFrame, periods: Iterable[int] = SMA_PERIODS, series: Series = DAILY, min_periods: int = 1
) -> DataFrame:
    """``min_periods=1`` averages partial windows at the start of a series."""
    averages = {f"sma_{n}": sma(n, min_periods) for n in periods}
    return _from_parts(df, rolling_sums(periods, series), averages)


def with_full_window_averages(
    df: DataFrame, periods: Iterable[int] = SMA_PERIODS, series: Series = DAILY
) -> DataFrame:
    """Averages that stay NULL until their window holds all its prices."""
    averages = {f"sma_{n}": sma(n, min_periods=n) for n in periods}
    return _from_parts(df, rolling_sums(periods, series), averages)


def with_simple_ema(
    df: DataFrame, periods: Iterable[int] = EMA_PERIODS, series: Series = DAILY
) -> DataFrame:
    averages = {f"ema_{n}": ema_simple(n) for n in periods}
    return _from_parts(df, rolling_sums(periods, series), averages)


def with_volatility(
    df: DataFrame,
    n: int = VOLATILITY_WINDOW,
    series: Series = DAILY,
    min_periods: int = 2,
    returns: str = "daily_return",
) -> DataFrame:
    """Sample standard deviation of the last ``n`` returns; NULL below ``min_periods`` of them."""
    frame = series.last(n)
    spread = F.round(F.stddev_samp(returns).over(frame), 4)
    if min_periods > 2:
        spread = F.when(F.count(returns).over(frame) >= min_periods, spread)
    return df.withColumn(f"volatility_{n}d", spread)


def with_indicators(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """All fact indicators: one exchange, one sort, and three windows.

    The second window is for the differences of sums of the first, the third for the volatility,
    which needs the returns.
    """
    of_row, grown, before, differences = rolling_sums((*SMA_PERIODS, *EMA_PERIODS), series)
    parts = [of_row, grown | previous_values(series), before, differences]
    results = derived_metrics()
    results |= {f"sma_{n}": sma(n) for n in SMA_PERIODS}
    results |= {f"ema_{n}": ema_simple(n) for n in EMA_PERIODS}
    return with_volatility(_from_parts(df, parts, results), VOLATILITY_WINDOW, series)
