from tickloom.operators import cleanse as c
from tickloom.operators.enrich import enrich, standardise_dates
from tickloom.functions.scalars import parseable_timestamp, to_number
from tickloom.schema import FACT_SCHEMA
from pyspark.sql import functions as F


def test_missing_keys_are_dropped(raw):
    df = raw({}, {"symbol": None}, {"timestamp": None})
    assert c.drop_missing_keys(df).count() == 1


def test_negative_prices_become_null_and_zero_stays(raw):
    row = c.cleanse(raw({"close_price": -1.0, "open_price": 0.0})).first()
    assert row["close_price"] is None and row["open_price"] == 0.0


def test_high_below_low_is_dropped_only_if_both_are_there(raw):
    df = raw(
        {"timestamp": "2024-01-02", "high_price": 90.0, "low_price": 95.0},
        {"timestamp": "2024-01-03", "high_price": None, "low_price": 95.0},
        {"timestamp": "2024-01-04", "high_price": -1.0, "low_price": 95.0},
        {"timestamp": "2024-01-05", "high_price": 95.0, "low_price": 95.0},
    )
    kept = {r["timestamp"] for r in c.cleanse(df).collect()}
    assert kept == {"2024-01-03", "2024-01-04", "2024-01-05"}


def test_defaults(raw):
    row = c.cleanse(raw({"volume": None, "dividend_amount": None, "split_coefficient": None})).first()
    assert (row["volume"], row["dividend_amount"], row["split_coefficient"]) == (0, 0.0, 1.0)


def test_duplicates_by_standard_symbol(raw):
    df = raw({}, {"symbol": " aapl\t"}, {"symbol": "AAPL", "close_price": 11.5, "timestamp": "2024-01-03"})
    rows = c.cleanse(df).collect()
    assert sorted((r["symbol"], r["timestamp"]) for r in rows) == [("AAPL", "2024-01-02"), ("AAPL", "2024-01-03")]


def test_survivor_does_not_depend_on_order(raw):
    a, b = {"close_price": 10.5}, {"close_price": 11.5}
    assert c.cleanse(raw(a, b)).collect() == c.cleanse(raw(b, a)).collect()


def test_copies_are_limited_before_the_shuffle(raw):
    plan = c.deduplicate(raw({}))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_numbers_from_text(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), ("7",), (None,)], "t string")
    assert [r[0] for r in df.select(to_number("t", "double")).collect()] == [1.5, None, None, 7.0, None]
    assert [r[0] for r in df.select(to_number("t", "bigint")).collect()] == [1, None, None, 7, None]


def test_dates_that_do_not_parse_are_dropped(raw):
    df = raw({"timestamp": "not-a-date"}, {"timestamp": "2024-01-02 10:30:00"}, {"timestamp": "2024-02-30"})
    rows = standardise_dates(df).collect()
    assert [str(r["trade_date"]) for r in rows] == ["2024-01-02"]


def test_timestamps_in_other_spellings(spark):
    good = ["2024-01-02", "2024-01-02T03:04:05", "20240102", "1/2/2024", "2 Jan 2024", "Jan 2, 2024"]
    df = spark.createDataFrame([(t,) for t in [*good, "tomorrow", ""]], "t string")
    parsed = [r[0] is not None for r in df.select(parseable_timestamp("t")).collect()]
    assert parsed == [True] * len(good) + [False, False]


def test_fact_has_the_declared_schema(raw):
    fact = enrich(c.cleanse(raw({}, {"timestamp": "2024-01-03"})))
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in FACT_SCHEMA]
    assert {r["price_id"] for r in fact.collect()} == {"AAPL_20240102", "AAPL_20240103"}
    assert fact.select(F.count_distinct("processing_timestamp")).first()[0] == 1


def test_cleansing_report(raw):
    df = raw({}, {}, {"symbol": None})
    assert c.cleansing_report(df, c.cleanse(df)).first().asDict() == {
        "rows_before": 3, "rows_after": 1, "rows_removed": 2,
    }
