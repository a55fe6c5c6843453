"""Scalar column expressions. All of them stay inside the JVM and never throw on bad data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Price steps per unit.
PRICE_SCALE = 10_000
# Prices below 1e14 of up to eight decimals, whose sums are exact.
EXACT_PRICE = "decimal(22,8)"
# Prices below this may be summed in whole steps.
WHOLE_BELOW = 1e6


BLANKS = " \t\r\n\f\v"


def standard_symbol(symbol: Column | str) -> Column:
    return F.upper(F.btrim(symbol, F.lit(BLANKS)))


def to_number(column: Column | str, dtype: str) -> Column:
    """Numeric coercion: text that is no number, and NaN, become NULL."""
    column = F.col(column) if isinstance(column, str) else column
    if dtype == "double":
        return F.nanvl(column.try_cast(dtype), F.lit(None).cast(dtype))
    # Whole numbers may be written as "1200.0".
    return F.coalesce(column.try_cast(dtype), column.try_cast("double").try_cast(dtype))


def non_negative(column: Column | str) -> Column:
    """NULL for negative values and NaN; zero is kept."""
    column = F.col(column) if isinstance(column, str) else column
    return F.nanvl(F.when(column >= 0, column), F.lit(None).cast("double"))


def pct_change(current: Column, base: Column) -> Column:
    """Change against a base in percent; NULL unless the base is positive."""
    return F.when(base > 0, (current - base) / base * 100.0)


def surrogate_key(symbol: str = "symbol", trade_date: str = "trade_date") -> Column:
    return F.concat_ws("_", F.col(symbol), F.date_format(trade_date, "yyyyMMdd"))


def day_of_week(date: Column | str, week_start: str = "sunday") -> Column:
    """1 to 7, counted from Sunday (default) or Monday."""
    if week_start == "sunday":
        return F.dayofweek(date)
    if week_start == "monday":
        return F.weekday(date) + 1
    raise ValueError(f"week_start must be 'sunday' or 'monday', not {week_start!r}")


# Further date spellings tried after the ISO forms Spark casts by itself.
DATE_FORMATS = ["yyyyMMdd", "M/d/yyyy", "M-d-yyyy", "yyyy/M/d", "d MMM yyyy", "MMM d, yyyy"]


def parseable_timestamp(column: Column | str) -> Column:
    """The timestamp under the first format that fits, else NULL."""
    column = F.col(column) if isinstance(column, str) else column
    tries = [F.try_to_timestamp(column)]
    tries += [F.try_to_timestamp(column, F.lit(fmt)) for fmt in DATE_FORMATS]
    return reduce(lambda a, b: F.coalesce(a, b), tries)


def known_price(price: Column | str) -> Column:
    """The price as a double; NULL for NaN."""
    price = F.col(price) if isinstance(price, str) else price
    return F.nanvl(price.cast("double"), F.lit(None).cast("double"))


def price_steps(price: Column | str) -> Column:
    """Price as an exact number of 1/10000 steps; NULL for what is no ``EXACT_PRICE``.

    Sums of decimals do not depend on the order in which rows arrive, so means come out
    the same however Spark partitions the work. Where a price has no steps, the mean is that of doubles.
    """
    price = known_price(price)
    exact = price.try_cast(EXACT_PRICE)
    return F.when(exact.cast("double") == price, (exact * PRICE_SCALE).cast("decimal(22,4)"))


def whole_steps(price: Column | str) -> Column:
    """``price_steps`` as a long integer, where it is a whole number; NULL for others and for prices from ``WHOLE_BELOW`` on.

    Nearly all prices have four decimals, and long integers are summed many times faster than
    decimals. The bound keeps the sum of a series of 900 million rows within a long.
    """
    price = known_price(price)
    nearest = F.when(F.abs(price) < WHOLE_BELOW, F.rint(price * float(PRICE_SCALE)).cast("long"))
    return F.when(nearest / float(PRICE_SCALE) == price, nearest)


def mean_of_steps(total: Column, n: Column, decimals: int = 4) -> Column:
    """Mean price of ``n`` prices from their summed steps, rounded half up; NULL for no prices."""
    unit = PRICE_SCALE // 10**decimals
    return F.when(n > 0, half_up_ratio(total, n * unit) / float(10**decimals))


def half_up_ratio(numerator: Column, denominator: Column) -> Column:
    """The whole number nearest to a ratio of whole numbers, halves away from zero."""
    magnitude = F.call_function("div", F.abs(numerator) * 2 + denominator, denominator * 2)
    return F.signum(numerator) * magnitude


def mean_price(price: str) -> Column:
    """Aggregate: the mean price, not rounded, the same for any order of the rows if all prices are exact."""
    steps, known = price_steps(price), known_price(price)
    exact = F.sum(steps).cast("double") / float(PRICE_SCALE) / F.count(steps)
    return F.when(F.count(steps) == F.count(known), F.when(F.count(steps) > 0, exact)).otherwise(F.avg(known))


def rounded_mean_price(price: str, decimals: int) -> Column:
    """Aggregate: the mean price rounded half up, from the exact sum if all prices are exact."""
    steps, known = price_steps(price), known_price(price)
    exact = mean_of_steps(F.sum(steps), F.count(steps), decimals)
    return F.when(F.count(steps) == F.count(known), exact).otherwise(F.round(F.avg(known), decimals))
