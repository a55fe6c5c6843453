import json

import pytest
from pyspark.sql import functions as F

from tickloom.operators import quality as q


def outcome(df, *rules):
    return q.evaluate(df, q.Suite("s", rules)).collect()


def test_range_ignores_nulls_and_holds_on_nothing(raw):
    df = raw({"close_price": None}, {"close_price": -1.0}, *[{"close_price": 5.0}] * 98)
    (row,) = outcome(df, q.between("close_price", 0))
    assert (row["considered"], row["violations"], row["success"]) == (99, 1, False)
    assert row["success_rate"] == 0.9899
    (row,) = outcome(df.filter("close_price IS NULL"), q.between("close_price", 0))
    assert row["success"] and row["success_rate"] == 1.0


def test_mostly_is_inclusive(raw):
    df = raw({"close_price": -1.0}, *[{}] * 3)
    assert outcome(df, q.between("close_price", 0, mostly=0.75))[0]["success"]
    assert not outcome(df, q.between("close_price", 0, mostly=0.76))[0]["success"]


def test_missing_column_fails(raw):
    (row,) = outcome(raw({}).drop("volume"), q.between("volume", 0))
    assert not row["success"] and "volume" in json.loads(row["details"])["error"]


def test_required_columns_list_the_missing(raw):
    (row,) = outcome(raw({}).drop("volume", "symbol"), q.CORE_SUITE.rules[0])
    assert json.loads(row["details"])["missing_columns"] == ["symbol", "volume"] and not row["success"]


def test_null_percentage(raw):
    (row,) = outcome(raw({}, {}, {"symbol": None}), q.not_null("symbol"))
    assert json.loads(row["details"]) == {"null_count": 1, "total_count": 3, "null_percentage": 33.33}


def test_bounds_from_the_same_row(raw):
    rule = q.between("open_price", q.column_bound("low_price"), q.column_bound("high_price"), 1.0)
    (row,) = outcome(raw({}, {"open_price": 20.0}, {"open_price": 20.0, "high_price": None}), rule)
    assert (row["considered"], row["violations"]) == (2, 1)


def test_suites_pass_on_valid_bars_and_fail_on_none(raw):
    for suite, n in ((q.FULL_SUITE, 17), (q.CORE_SUITE, 11)):
        results = q.evaluate(raw({}), suite)
        assert results.count() == n and results.filter("NOT success").isEmpty()
        empty = q.evaluate(raw({}).filter("FALSE"), suite)
        assert [r["expectation_type"] for r in empty.filter("NOT success").collect()] == [q.ROW_COUNT]


def test_class_share_symbol_fails_the_pattern(raw):
    failed = q.evaluate(raw({"symbol": "BRK.A", "close_price": 605000.0, "high_price": 605000.0}), q.FULL_SUITE)
    assert [r["column_name"] for r in failed.filter("NOT success").collect()] == ["symbol"]


def test_column_order_matters_to_the_full_suite(raw):
    swapped = raw({}).select("timestamp", "symbol", *raw({}).columns[2:])
    assert not q.evaluate(swapped, q.FULL_SUITE).filter("rule_no = 1").first()["success"]


def test_suite_document():
    suite = q.load_suite(
        json.dumps(
            {
                "expectation_suite_name": "mine",
                "expectations": [
                    {"expectation_type": q.BETWEEN, "kwargs": {"column": "volume", "min_value": 0, "mostly": 0.9}}
                ],
            }
        )
    )
    assert suite == q.Suite("mine", (q.Rule(q.BETWEEN, "volume", 0.9, {"min_value": 0}),))
    with pytest.raises(q.SuiteError):
        q.load_suite({"expectations": [{"expectation_type": "expect_rain"}]})


def test_gate(raw):
    good, bad = raw({}), raw({}, {"symbol": None})
    assert q.gate(q.evaluate(good, q.FULL_SUITE)) == {"evaluated": 17, "failed": 0}
    results = q.evaluate(bad, q.FULL_SUITE)
    with pytest.raises(q.QualityGateError, match="symbol"):
        q.gate(results)
    assert q.gate(results, max_failed_ratio=0.1)["failed"] == 1
    with pytest.raises(q.QualityGateError, match="nothing"):
        q.gate(results.filter("FALSE"))


def test_results_per_file(raw):
    df = raw({}).withColumn("source_file", F.lit("a")).unionByName(
        raw({}, {"symbol": None}).withColumn("source_file", F.lit("b"))
    )
    results = q.evaluate(df, q.FULL_SUITE, by=["source_file"])
    reports = q.report(results, by=["source_file"])
    assert {r["source_file"]: r["success"] for r in reports.collect()} == {"a": True, "b": False}
    assert q.verdict(reports).first().asDict() == {
        "files": 2, "passed_files": 1, "failed_files": 1, "overall_success": False,
    }


def test_a_suite_is_one_scan(raw):
    plan = q.evaluate(raw({}), q.FULL_SUITE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_summary_by_symbol(raw):
    rows = q.summary_by_symbol(raw({}, {"volume": -1}, {"symbol": "MSFT"})).collect()
    got = {(r["symbol"], r["is_total"]): (r["records_validated"], r["errors"], r["pass_rate"]) for r in rows}
    assert got == {("AAPL", 0): (2, 1, 0.5), ("MSFT", 0): (1, 0, 1.0), (None, 1): (3, 1, 0.6667)}


def test_fact_and_ohlc_checks(raw):
    assert q.check_fact(raw({})).first()["success"]
    assert not q.check_fact(raw({"close_price": None})).first()["success"]
    assert not q.check_ohlc(raw({"close_price": 13.0})).first()["success"]
