import math
import random
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions import indicators as ind
from tickloom.functions.scalars import day_of_week
from tickloom.operators.enrich import BAR_SERIES, INDICATOR_DEPTH
from tickloom.operators.long_series import cut_long_series
from tickloom.operators.recursive_ema import with_recursive_ema, with_recursive_ema_blocked
from tickloom.session import store


def column(df, name, order="trade_date"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_partial_and_full_windows(closes):
    df = closes([1.0, 2.0, 3.0])
    assert column(ind.with_moving_averages(df, (5,)), "sma_5") == [1.0, 1.5, 2.0]
    assert column(ind.with_full_window_averages(df, (5,)), "sma_5") == [None] * 3
    assert column(ind.with_moving_averages(df, (2,), min_periods=2), "sma_2") == [None, 1.5, 2.5]


def test_average_ignores_nulls_and_rounds_half_up(closes):
    df = closes([1.0001, 1.0002, None, None])
    assert column(ind.with_moving_averages(df, (2,)), "sma_2") == [1.0001, 1.0002, 1.0002, None]
    # The mean of 1.0001 and 1.0002 lies halfway.
    assert column(ind.with_moving_averages(closes([1.0001, 1.0002]), (5,)), "sma_5")[1] == 1.0002


def test_simple_ema(closes):
    values = [10.0, 11.0, 12.5]
    k = 2 / 13
    means = [10.0, 10.5, 33.5 / 3]
    wanted = [round(m * k + v * (1 - k), 4) for m, v in zip(means, values)]
    assert column(ind.with_simple_ema(closes(values), (12,)), "ema_12") == wanted
    assert column(ind.with_simple_ema(closes([1.0, None]), (12,)), "ema_12") == [1.0, None]


def test_returns_guard_zero_and_first_row(closes):
    df = ind.with_derived_metrics(
        closes([0.0, 5.0, 10.0]).withColumns({"high_price": F.lit(2.0), "low_price": F.lit(1.0)})
    )
    assert column(df, "daily_return") == [None, None, 100.0]
    assert column(df, "daily_range_pct") == [None, 20.0, 10.0]
    assert column(df, "volume_change_pct") == [None, 0.0, 0.0]
    assert not any(c.startswith("_") for c in df.columns)


def test_volatility(closes):
    df = closes([1.0, 2.0, 4.0, 5.0]).withColumn("daily_return", F.col("close_price"))
    spread = column(ind.with_volatility(df, 20), "volatility_20d")
    assert spread == [None] + [round(np.std(v, ddof=1), 4) for v in ([1, 2], [1, 2, 4], [1, 2, 4, 5])]
    assert column(ind.with_volatility(df, 20, min_periods=4), "volatility_20d")[:3] == [None] * 3


def test_recursive_ema_carries_on_over_nulls(closes):
    df = with_recursive_ema(closes([1.0, None, 3.0, 5.0]), (3,))
    assert column(df, "ema_recursive_3") == [1.0, 1.0, 2.3333, 3.6667]


def test_recursive_ema_over_many_batches(spark, closes):
    rng = random.Random(3)
    values = [None if rng.random() < 0.3 else rng.uniform(1, 100) for _ in range(500)]
    df = closes(values).unionByName(closes([None, 7.0], "OTHER"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = with_recursive_ema(df, (12, 26)).filter("symbol = 'TEST'")
        got = {s: column(rows, f"ema_recursive_{s}") for s in (12, 26)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for s in (12, 26):
        wanted = pd.Series(values, dtype="float64").ewm(span=s, adjust=False).mean()
        same = [(g is None and math.isnan(w)) or abs(g - w) < 5.1e-5 for g, w in zip(got[s], wanted)]
        assert all(same)


def test_day_of_week(spark):
    row = spark.sql("SELECT DATE'2024-01-01' AS d").select(
        day_of_week("d").alias("s"), day_of_week("d", "monday").alias("m")
    ).first()
    assert (row["s"], row["m"]) == (2, 1)
    with pytest.raises(ValueError):
        day_of_week("d", "friday")


@pytest.fixture(scope="module")
def lopsided(spark):
    """One symbol holds most rows, unevenly spread over time, with gaps in its prices."""
    rng = random.Random(11)
    rows = []
    for symbol, n in (("HOT", 3000), ("WARM", 400), ("COLD", 40), ("ONE", 1)):
        at = datetime(2024, 1, 1)
        for _ in range(n):
            at += timedelta(seconds=rng.choice([1, 2, 60, 86400 * 3]))
            close = None if rng.random() < 0.2 else round(rng.uniform(1, 500), 4)
            rows.append((symbol, at.isoformat(" "), at.date(), at, close, rng.randrange(1000)))
    # Half a day without any price, longer than several blocks.
    rows = [r[:4] + (None,) + r[5:] if r[0] == "HOT" and 1200 < i < 1500 else r for i, r in enumerate(rows)]
    schema = "symbol string, timestamp string, trade_date date, trade_timestamp timestamp, close_price double, volume long"
    df = spark.createDataFrame(rows, schema).withColumns(
        {"high_price": F.col("close_price") + 1, "low_price": F.col("close_price") - 1}
    )
    return store(df, "lopsided")


@pytest.mark.parametrize("size", [20, 64, 700])
def test_cut_series_give_the_same_indicators(lopsided, size):
    whole = ind.with_indicators(lopsided, BAR_SERIES)
    blocked = cut_long_series(lopsided, BAR_SERIES, INDICATOR_DEPTH, rows_per_block=size)
    assert blocked.is_cut
    largest = blocked.rows.filter("NOT _lead_in").groupBy("symbol", "_block").count().agg(F.max("count")).first()[0]
    assert largest <= 3 * size + 10
    cut = blocked.apply(ind.with_indicators).select(whole.columns)
    assert cut.count() == whole.count()
    # The spread of returns is summed in another order; all else must be equal.
    exact = [c for c in whole.columns if c != "volatility_20d"]
    assert cut.select(exact).exceptAll(whole.select(exact)).isEmpty()
    both = whole.select("symbol", "timestamp", "volatility_20d").join(
        cut.select("symbol", "timestamp", F.col("volatility_20d").alias("v")), ["symbol", "timestamp"]
    )
    assert both.filter("NOT (volatility_20d <=> v) AND coalesce(abs(volatility_20d - v) > 0.0001, TRUE)").isEmpty()


@pytest.mark.parametrize("size", [20, 64, 700])
def test_cut_series_give_the_same_recursive_ema(lopsided, size):
    whole = with_recursive_ema(lopsided, (12, 26), BAR_SERIES)
    blocked = cut_long_series(lopsided, BAR_SERIES, 0, rows_per_block=size)
    cut = with_recursive_ema_blocked(blocked, (12, 26))
    both = whole.join(
        cut.select("symbol", "timestamp", F.col("ema_recursive_12").alias("a"), F.col("ema_recursive_26").alias("b")),
        ["symbol", "timestamp"],
    )
    assert both.count() == lopsided.count()
    wrong = both.filter(
        "NOT (ema_recursive_12 <=> a) AND coalesce(abs(ema_recursive_12 - a) > 0.0001, TRUE)"
        " OR NOT (ema_recursive_26 <=> b) AND coalesce(abs(ema_recursive_26 - b) > 0.0001, TRUE)"
    )
    assert wrong.isEmpty()


def test_short_series_are_left_alone(lopsided):
    blocked = cut_long_series(lopsided, BAR_SERIES, INDICATOR_DEPTH)
    assert not blocked.is_cut and blocked.rows is lopsided


def test_number_of_blocks_is_bounded(lopsided):
    blocked = cut_long_series(lopsided, BAR_SERIES, INDICATOR_DEPTH, rows_per_block=1, max_blocks=10)
    assert blocked.rows.select("symbol", "_block").distinct().count() <= 24


def test_indicators_need_one_exchange(spark, closes):
    df = closes([1.0, 2.0]).withColumns({"high_price": F.lit(2.0), "low_price": F.lit(1.0)})
    plan = ind.with_indicators(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1


def test_rounding_is_half_up_on_the_exact_value(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from tickloom.functions.scalars import mean_of_steps, rounded_mean_price

    rng = random.Random(2)
    rows = [(rng.randrange(-10**9, 10**12), rng.randrange(1, 60)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "total long, n long")
    for decimals in (2, 4):
        got = df.select(mean_of_steps(F.col("total"), F.col("n"), decimals)).collect()
        exact = [(Decimal(t) / n / 10000).quantize(Decimal(10) ** -decimals, ROUND_HALF_UP) for t, n in rows]
        assert [r[0] for r in got] == [float(e) for e in exact]
    # Sums of many large prices do not overflow.
    large = spark.range(2000).select(F.lit(9.9e10).alias("p"))
    assert large.agg(rounded_mean_price("p", 2)).first()[0] == 9.9e10


@pytest.mark.parametrize("values", [[2e11, 1.0], [1e300, 3e300], [0.000001, 0.000002], [1.000049, 1.00005], [1e-12, 3e-12], [2e11, None, 1.0]])
def test_every_price_counts_whole(spark, closes, values):
    from tickloom.functions.scalars import mean_price, rounded_mean_price

    known = [v for v in values if v is not None]
    mean, last = sum(known) / len(known), values[-1]
    row = closes(values).agg(mean_price("close_price"), rounded_mean_price("close_price", 2)).first()
    assert row[0] == pytest.approx(mean, rel=1e-12) and row[1] == pytest.approx(round(mean, 2), rel=1e-12)
    shown = ind.with_simple_ema(ind.with_moving_averages(closes(values))).orderBy("trade_date").collect()[-1]
    assert shown.sma_5 == pytest.approx(round(mean, 4), rel=1e-12)
    assert shown.ema_12 == pytest.approx(round(mean * 2 / 13 + last * 11 / 13, 4), rel=1e-12)


def test_executors_need_not_have_the_package(tmp_path):
    import os
    import subprocess
    import sys

    script = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession
from tickloom.operators.recursive_ema import with_recursive_ema
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([("A", i, float(i)) for i in range(3)], "symbol string, trade_date int, close_price double")
print([r[-1] for r in with_recursive_ema(df, (3,)).orderBy("trade_date").collect()])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120
    )
    assert "[0.0, 0.5, 1.25]" in done.stdout, done.stderr[-2000:]


def test_prices_of_any_precision_share_a_window(spark, closes):
    """Whole steps, finer ones, doubles and gaps in one series: each window by the precision of its own prices."""
    from decimal import ROUND_HALF_UP, Decimal

    rng = random.Random(8)
    values = [rng.choice([round(rng.uniform(0, 300), 4), 1.23455, 0.0, None, -2.5, 999999.9999, 1e6, 1e9 + 0.00005]) for _ in range(150)]
    values += [1e-12, 3e300] + [round(rng.uniform(0, 300), 4) for _ in range(80)]
    rows = ind.with_simple_ema(ind.with_moving_averages(closes(values))).orderBy("trade_date").collect()
    for i, row in enumerate(rows):
        for n in ind.SMA_PERIODS:
            window = [v for v in values[max(0, i - n + 1) : i + 1] if v is not None]
            if not {1e-12, 3e300} & set(window):
                exact = sum(Decimal(repr(v)) for v in window) / len(window) if window else None
                assert row[f"sma_{n}"] == (None if exact is None else float(exact.quantize(Decimal("0.0001"), ROUND_HALF_UP)))
        for n in ind.EMA_PERIODS:
            window = [v for v in values[max(0, i - n + 1) : i + 1] if v is not None]
            if values[i] is None:
                assert row[f"ema_{n}"] is None
            elif not {1e-12, 3e300} & set(window):
                total = sum(Decimal(repr(v)) for v in window)
                exact = (total * 2 + Decimal(repr(values[i])) * (n - 1) * len(window)) / (len(window) * (n + 1))
                assert row[f"ema_{n}"] == float(exact.quantize(Decimal("0.0001"), ROUND_HALF_UP))


def test_exact_sums_are_not_taken_in_sliding_frames(closes):
    plan = ind.with_moving_averages(closes([1.0, 2.0]))._jdf.queryExecution().optimizedPlan().toString()
    import re

    sliding = re.findall(r"(\w+)\(([^()]*)\) windowspecdefinition\([^)]*?RowFrame, -\d+, currentrow", plan)
    assert {name for name, _ in sliding} == {"avg"}
    assert "decimal" not in "".join(argument for _, argument in sliding)
