"""Queries over the quality rules, suites, reports and the gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import file_gate, quality as q
from tickloom.operators.enrich import standardise_dates
from tickloom.plans import landing
from tickloom.plans.derived import daily_fact, dirty_bars, event_bars, ship_bars, type_bars
from tickloom.plans.oracle import DIRTY_BARS, EVENT_BARS, RAW_LIST, SHIP_BARS, TYPE_BARS
from tickloom.plans.registry import checked
from tickloom.schema import RAW_COLUMNS
from tickloom.sources import json_bars

OUTCOME = ["rule_no", "expectation_type", "column_name", "success", "considered", "violations", "success_rate"]


def _between(number, column, low, high, mostly):
    """A rule as the SQL of its considered rows and of its violations."""
    outside = [f"{column} < {low}"] if low is not None else []
    outside += [f"{column} > {high}"] if high is not None else []
    return (number, q.BETWEEN, column, mostly, f"{column} IS NOT NULL", " OR ".join(outside))


def _not_null(number, column):
    return (number, q.NOT_NULL, column, 1.0, "TRUE", f'"{column}" IS NULL')


BOTH = "high_price IS NOT NULL AND low_price IS NOT NULL"
PARSES = "TRY_CAST(\"timestamp\" AS TIMESTAMP) IS NULL"
FULL_RULES = [
    _not_null(2, "symbol"),
    _not_null(3, "timestamp"),
    _not_null(4, "close_price"),
    _between(5, "open_price", 0, 1000000, 0.99),
    _between(6, "high_price", 0, 1000000, 0.99),
    _between(7, "low_price", 0, 1000000, 0.99),
    _between(8, "close_price", 0, 1000000, 0.99),
    _between(9, "volume", 0, None, 0.95),
    (10, q.GREATER, "high_price,low_price", 0.99, BOTH, "high_price < low_price"),
    (11, q.BETWEEN, "open_price", 0.99, f"open_price IS NOT NULL AND {BOTH}",
     "open_price < low_price OR open_price > high_price"),
    (12, q.BETWEEN, "close_price", 0.99, f"close_price IS NOT NULL AND {BOTH}",
     "close_price < low_price OR close_price > high_price"),
    (13, q.REGEX, "symbol", 0.99, "symbol IS NOT NULL", "NOT regexp_matches(symbol, '^[A-Z]{1,5}$')"),
    (14, q.PARSEABLE, "timestamp", 1.0, '"timestamp" IS NOT NULL', PARSES),
    _between(16, "split_coefficient", 0, 100, 0.99),
    _between(17, "dividend_amount", 0, None, 0.99),
]
CORE_RULES = [
    _not_null(2, "symbol"),
    _not_null(3, "timestamp"),
    _not_null(4, "close_price"),
    _between(5, "high_price", 0, None, 0.99),
    _between(6, "low_price", 0, None, 0.99),
    _between(7, "open_price", 0, None, 0.99),
    _between(8, "close_price", 0, None, 0.99),
    _between(9, "volume", 0, None, 0.99),
    (10, q.GREATER, "high_price,low_price", 1.0, BOTH, "high_price < low_price"),
]


def outcomes(bars: str, rules: list, by: str | None = None) -> str:
    """The row-level rules of a suite, one SELECT each."""
    lines = []
    for number, kind, column, mostly, present, violated in rules:
        share = "CASE WHEN n > 0 THEN 1 - bad / CAST(n AS DOUBLE) ELSE 1 END"
        group = f"{by}, " if by else ""
        lines.append(
            f"""SELECT {group}CAST({number} AS INTEGER) AS rule_no, '{kind}' AS expectation_type,
            '{column}' AS column_name, {share} >= {mostly} AS success, n AS considered, bad AS violations,
            round({share}, 4) AS success_rate
            FROM (SELECT {group}count(*) FILTER ({present}) AS n,
                         count(*) FILTER (({present}) AND ({violated})) AS bad
                  FROM {bars} {f"GROUP BY {by}" if by else ""})"""
        )
    return " UNION ALL ".join(lines)


def _table_rule(bars: str, number: int, kind: str, success: str, considered: str) -> str:
    return f""" UNION ALL SELECT CAST({number} AS INTEGER), '{kind}', NULL, {success},
    {considered}, NULL, NULL FROM {bars}"""


def full_suite(bars: str) -> str:
    columns = _table_rule(bars, 1, q.ORDERED_COLUMNS, "bool_and(TRUE)", "CAST(NULL AS BIGINT)")
    rows = _table_rule(bars, 15, q.ROW_COUNT, "count(*) BETWEEN 1 AND 50000", "count(*)")
    return outcomes(bars, FULL_RULES) + columns + rows


def core_suite(bars: str) -> str:
    columns = _table_rule(bars, 1, q.COLUMNS_EXIST, "bool_and(TRUE)", "CAST(NULL AS BIGINT)")
    rows = _table_rule(bars, 11, q.ROW_COUNT, "count(*) BETWEEN 1 AND 50000", "count(*)")
    return outcomes(bars, CORE_RULES) + columns + rows


@checked("v1_v17_full_suite", f"WITH {DIRTY_BARS} {full_suite('dirty_bars')}")
def full_suite_on_dirty(spark, sf_dir):
    return q.evaluate(dirty_bars(spark, sf_dir), q.FULL_SUITE).select(OUTCOME)


@checked("v13_v24_suite_from_document", f"WITH {TYPE_BARS} {full_suite('type_bars')}")
def suite_from_document(spark, sf_dir):
    """The suite read from its JSON form, on symbols that are too long for it."""
    document = {
        "expectation_suite_name": q.FULL_SUITE.name,
        "expectations": [
            {
                "expectation_type": r.kind,
                "kwargs": {**({"column": r.column} if r.column else {}), "mostly": r.mostly, **r.args},
            }
            for r in q.FULL_SUITE.rules
        ],
    }
    return q.evaluate(type_bars(spark, sf_dir), q.load_suite(document)).select(OUTCOME)


@checked("v18_v23_core_suite", f"WITH {DIRTY_BARS} {core_suite('dirty_bars')}")
def core_suite_on_dirty(spark, sf_dir):
    return q.evaluate(dirty_bars(spark, sf_dir), q.CORE_SUITE).select(OUTCOME)


@checked(
    "v19_null_percentages",
    f"""WITH {DIRTY_BARS} SELECT 'symbol' AS column_name, count(*) FILTER (symbol IS NULL) AS null_count,
      count(*) AS total_count, round(count(*) FILTER (symbol IS NULL) * 100.0::DOUBLE / count(*), 2) AS null_percentage
    FROM dirty_bars UNION ALL
    SELECT 'volume', count(*) FILTER (volume IS NULL), count(*),
      round(count(*) FILTER (volume IS NULL) * 100.0::DOUBLE / count(*), 2) FROM dirty_bars""",
)
def null_percentages(spark, sf_dir):
    suite = q.Suite("nulls", (q.not_null("symbol"), q.not_null("volume")))
    details = F.from_json("details", "null_count bigint, total_count bigint, null_percentage double")
    results = q.evaluate(dirty_bars(spark, sf_dir), suite)
    return results.select("column_name", details.alias("d")).select("column_name", "d.*")


# Files that the gate must judge beside those of the dirty bars: one without fault, one without
# records, one that is no JSON, and one whose records lack columns.
ODD_FILES = {
    "good": '{"meta": {"symbol": "ABC"}, "data": [{"symbol": "ABC", "timestamp": "2024-01-02", "open_price": 1.5, '
    '"high_price": 2.5, "low_price": 0.5, "close_price": 1.0, "adjusted_close": 1.0, "volume": 5, "dividend_amount": 0.0, '
    '"split_coefficient": 1.0}]}',
    "empty": '{"meta": {"symbol": "ABC"}, "data": []}',
    "broken": '{"meta": {"symbol": "ABC"}, "data": [',
    "poor": '{"data": [{"symbol": "ABC", "timestamp": "2024-01-02", "open_price": 1.5, "close_price": 1.0, "volume": 5}]}',
}
FILE_OF_BAR = "coalesce(right(upper(trim(symbol)), 1), 'none')"
RAW_NAMES = ", ".join(f"'{c}'" for c in RAW_COLUMNS)


def _file_rule(number: int, kind: str, column: str, mostly: float, present: str, violated: str) -> str:
    needed = [c for c in RAW_COLUMNS if f'{c}' in f"{column},{violated}".replace('"', "").replace(",", " ").split()]
    lacking = f"len(list_filter([{', '.join(repr(c) for c in needed)}], lambda c: NOT list_contains(columns, c))) > 0"
    share = "CASE WHEN coalesce(n, 0) > 0 THEN 1 - bad / CAST(n AS DOUBLE) ELSE 1 END"
    return f"""SELECT file, CAST({number} AS INTEGER) AS rule_no, '{kind}' AS expectation_type, '{column}' AS column_name,
      CASE WHEN {lacking} THEN FALSE ELSE {share} >= {mostly} END AS success,
      CASE WHEN NOT {lacking} THEN coalesce(n, 0) END AS considered, CASE WHEN NOT {lacking} THEN coalesce(bad, 0) END AS violations,
      CASE WHEN NOT {lacking} THEN round({share}, 4) END AS success_rate
    FROM files LEFT JOIN (SELECT file, count(*) FILTER ({present}) AS n, count(*) FILTER (({present}) AND ({violated})) AS bad
                          FROM all_bars GROUP BY 1) USING (file)"""


def files_suite() -> str:
    """CTEs and the outcomes of the full suite for every file."""
    rules = " UNION ALL ".join(_file_rule(*rule) for rule in FULL_RULES)
    return f"""{DIRTY_BARS}, all_bars AS (
      SELECT {FILE_OF_BAR} AS file, {RAW_LIST} FROM dirty_bars
      UNION ALL SELECT 'good', 'ABC', '2024-01-02', 1.5, 2.5, 0.5, 1.0, 1.0, 5, 0.0, 1.0
      UNION ALL SELECT 'poor', 'ABC', '2024-01-02', 1.5, NULL, NULL, 1.0, NULL, 5, NULL, NULL),
    files AS (
      SELECT DISTINCT {FILE_OF_BAR} AS file, [{RAW_NAMES}] AS columns FROM dirty_bars
      UNION ALL SELECT 'good', [{RAW_NAMES}]
      UNION ALL SELECT 'poor', ['symbol', 'timestamp', 'open_price', 'close_price', 'volume']
      UNION ALL SELECT 'empty', [] UNION ALL SELECT 'broken', []),
    results AS ({rules}
      UNION ALL SELECT file, 1, '{q.ORDERED_COLUMNS}', NULL, columns = [{RAW_NAMES}], NULL, NULL, NULL FROM files
      UNION ALL SELECT file, 15, '{q.ROW_COUNT}', NULL, coalesce(n, 0) BETWEEN 1 AND 50000, coalesce(n, 0), NULL, NULL
        FROM files LEFT JOIN (SELECT file, count(*) AS n FROM all_bars GROUP BY 1) USING (file)
      UNION ALL SELECT 'broken', 0, '{file_gate.READABLE}', NULL, FALSE, 1, 1, 0.0)"""


def _judged_files(spark, sf_dir):
    """The full suite over a folder of one file per last letter of the symbol, and the odd files."""
    bars = dirty_bars(spark, sf_dir).withColumn("file", F.expr(FILE_OF_BAR))
    path = landing.land_named_files(bars, ODD_FILES)
    rows = json_bars.read_bars(spark, path, pattern="part-*", multi_line=False)
    results = file_gate.evaluate_files(spark, path, q.FULL_SUITE, rows, pattern="part-*", multi_line=False)
    return results.withColumn("file", F.regexp_extract("source_file", "file=([^/]*)/", 1)).drop("source_file")


@checked("v25_results_per_file", f"WITH {files_suite()} SELECT * FROM results")
def results_per_file(spark, sf_dir):
    """All 17 rules for every listed file in one pass, files without rows included."""
    return _judged_files(spark, sf_dir).select("file", *OUTCOME)


@checked(
    "v25_gate_verdict",
    f"""WITH {files_suite()}, verdicts AS (SELECT file, bool_and(success) AS success FROM results GROUP BY 1)
    SELECT count(*) AS files, count(*) FILTER (success) AS passed_files,
    count(*) FILTER (NOT success) AS failed_files, bool_and(success) AS overall_success FROM verdicts""",
)
def gate_verdict(spark, sf_dir):
    return q.verdict(q.report(_judged_files(spark, sf_dir), by=["file"]))


@checked(
    "v25_results_per_symbol",
    f"WITH {DIRTY_BARS} {outcomes('dirty_bars', FULL_RULES, by='symbol')}",
)
def results_per_symbol(spark, sf_dir):
    """The row-level rules of the full suite per group in one pass."""
    results = q.evaluate(dirty_bars(spark, sf_dir), q.FULL_SUITE, by=["symbol"])
    return results.filter(F.col("column_name").isNotNull()).select("symbol", *OUTCOME)


@checked(
    "v26_validation_report",
    f"""WITH {DIRTY_BARS}, results AS ({full_suite('dirty_bars')})
    SELECT count(*) AS evaluated_expectations, count(*) FILTER (success) AS successful_expectations,
    count(*) FILTER (NOT success) AS unsuccessful_expectations, bool_and(success) AS success,
    string_agg(CAST(rule_no AS VARCHAR), ',' ORDER BY rule_no) FILTER (NOT success) AS failed_rules FROM results""",
)
def validation_report(spark, sf_dir):
    report = q.report(q.evaluate(dirty_bars(spark, sf_dir), q.FULL_SUITE))
    failed = F.transform("failed_expectations", lambda f: f["rule_no"].cast("string"))
    return report.select("*", F.array_join(failed, ",").alias("failed_rules")).drop("failed_expectations")


@checked(
    "v27_fact_check",
    f"""WITH {EVENT_BARS} SELECT count(*) FILTER (close_price IS NULL) AS null_close,
    count(*) FILTER (close_price < 0) AS negative_close,
    count(*) FILTER (close_price IS NULL OR close_price < 0) = 0 AS success FROM event_bars""",
)
def fact_check(spark, sf_dir):
    return q.check_fact(daily_fact(event_bars(spark, sf_dir)))


@checked(
    "v28_ohlc_relation",
    f"""WITH {DIRTY_BARS}, whole AS (SELECT * FROM dirty_bars WHERE open_price IS NOT NULL AND close_price IS NOT NULL
      AND high_price IS NOT NULL AND low_price IS NOT NULL)
    SELECT count(*) AS considered, count(*) FILTER (high_price < low_price OR open_price NOT BETWEEN low_price AND high_price
      OR close_price NOT BETWEEN low_price AND high_price) AS violations,
    count(*) FILTER (high_price < low_price OR open_price NOT BETWEEN low_price AND high_price
      OR close_price NOT BETWEEN low_price AND high_price) = 0 AS success FROM whole""",
)
def ohlc_relation(spark, sf_dir):
    return q.check_ohlc(dirty_bars(spark, sf_dir))


def _any_error() -> str:
    return " OR ".join(f"coalesce(({p}) AND ({v}), FALSE)" for _, _, _, _, p, v in FULL_RULES)


@checked(
    "v29_summary_by_symbol",
    f"""WITH {DIRTY_BARS}, flagged AS (SELECT symbol, {_any_error()} AS broken FROM dirty_bars)
    SELECT symbol, CAST(grouping(symbol) AS INTEGER) AS is_total, count(*) AS records_validated,
    count(*) FILTER (broken) AS errors,
    round(1 - count(*) FILTER (broken) / CAST(count(*) AS DOUBLE), 4) AS pass_rate
    FROM flagged GROUP BY ROLLUP (symbol)""",
)
def summary_by_symbol(spark, sf_dir):
    return q.summary_by_symbol(dirty_bars(spark, sf_dir))


@checked(
    "v30_rows_per_date",
    f"""WITH {SHIP_BARS}, days AS (SELECT DISTINCT trade_date FROM ship_bars UNION SELECT trade_date + 1 FROM ship_bars)
    SELECT days.trade_date, count(ship_bars.trade_date) AS row_count, count(ship_bars.trade_date) > 0 AS loaded
    FROM days LEFT JOIN ship_bars ON ship_bars.trade_date = days.trade_date GROUP BY 1""",
)
def rows_per_date(spark, sf_dir):
    """Rows of every date and of the day after each, which may have none."""
    dated = standardise_dates(ship_bars(spark, sf_dir)).select("trade_date")
    days = dated.unionByName(dated.select(F.date_add("trade_date", 1).alias("trade_date"))).distinct()
    counts = dated.groupBy("trade_date").agg(F.count("*").alias("n"))
    rows = F.coalesce("n", F.lit(0))
    return days.join(counts, "trade_date", "left").select("trade_date", rows.alias("row_count"), (rows > 0).alias("loaded"))
