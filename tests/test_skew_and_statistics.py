import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import order_statistics, reports, skew


@pytest.fixture(scope="module")
def counts(spark):
    rows = [("A", i) for i in range(7)] + [("B", 7), ("C", 8)]
    return spark.createDataFrame(rows, "symbol string, n long")


def test_report(counts):
    assert skew.skew_report(counts).first().asDict() == {
        "total_symbols": 3, "max_records": 7, "min_records": 1, "avg_records": 3, "skew_ratio": 7.0,
    }


def test_hot_symbols(counts):
    assert [r["symbol"] for r in skew.hot_symbols(counts).collect()] == ["A"]
    assert skew.skew_verdict(counts).first()["is_skewed"]
    even = counts.filter("n < 2 OR n > 6")
    assert not skew.skew_verdict(even).first()["is_skewed"]


def test_salted_keys_spread_hot_symbols_only(counts):
    salted = skew.with_salted_key(counts, F.col("n"), buckets=4)
    keys = {r["partition_salt"] for r in salted.collect()}
    assert keys == {"A_0", "A_1", "A_2", "A_3", "B", "C"}


def test_salted_totals_equal_plain_ones(spark):
    rng = random.Random(5)
    rows = [(rng.choice("AAAAB"), rng.choice([None, *range(40)])) for _ in range(500)]
    df = spark.createDataFrame(rows, "symbol string, n long")
    plain = df.groupBy("symbol").agg(
        F.count("*").alias("record_count"), F.sum("n").alias("total"), F.min("n").alias("least"),
        F.max("n").alias("greatest"), F.count_distinct("n").alias("different_values"),
    )
    assert sorted(skew.salted_totals(df, "n").collect()) == sorted(plain.collect())


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [1.0, 2.0],
        [5.0] * 40,
        [1e-300, 1.0, 1e300, -1e308, 1.7e308],
        [1e9, 1e9 + 1.2e-7, 1e9 + 2.4e-7, 1e9],
        [random.Random(1).gauss(0, 1) ** 9 for _ in range(3000)],
    ],
)
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = order_statistics.exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 0.75, 1.0])["v"]
    at = [np.sort(values)[i] for i in (0, -1)]
    assert [got[0], got[-1]] == at
    wanted = np.quantile(np.array(values) / 4, [0.25, 0.5, 0.75]) * 4
    assert np.allclose(got[1:4], wanted, rtol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert order_statistics.exact_quantiles(df, ["v"], [0.5]) == {"v": [None]}


def test_ingest_without_success_is_an_error(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", False)], "batch string, ok boolean")
    summary = reports.ingest_summary(df, "batch", F.col("ok"))
    with pytest.raises(RuntimeError, match="b"):
        reports.require_usable(summary)
    reports.require_usable(summary.filter("batch = 'a'"))


def test_dimension_join_has_no_forced_broadcast(spark):
    fact = spark.createDataFrame([("A", 1)], "symbol string, x long")
    dim = spark.createDataFrame([("A", "a", None, None)], "symbol string, company_name string, created_at date, updated_at date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = reports.with_symbol_details(fact, dim)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan


def test_top_rows_are_not_fully_sorted(spark):
    fact = spark.createDataFrame([("A", None, 1.0, 1.0, 1.0)], "symbol string, trade_date date, close_price double, sma_20 double, daily_return double")
    plan = reports.latest_prices(fact)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_totals_beyond_a_long(spark):
    df = spark.createDataFrame([("A", 5 * 10**18), ("A", 5 * 10**18), ("A", None)], "symbol string, n long")
    assert [int(r.total) for r in skew.salted_totals(df, "n").collect()] == [10**19]


def test_quantiles_with_infinities_end(spark):
    values = [None, 1.0, 2.0, 3.0, float("inf"), float("-inf"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = order_statistics.exact_quantiles(df, ["x"], [0.0, 0.4, 0.5, 1.0])
    assert found["x"] == [float("-inf"), 2.0, 2.5, float("inf")]
