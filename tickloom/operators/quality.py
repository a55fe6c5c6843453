"""Data quality: declarative rules, all evaluated in one aggregation.

Every row-level rule is a pair of counters: rows considered (its columns are present) and
rows violating it. A suite of any length therefore costs one scan, with counters combined
before the shuffle, also when results are wanted per source file or per symbol.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.scalars import parseable_timestamp
from tickloom.schema import RAW_COLUMNS


class QualityGateError(Exception):
    """Raised when data fails its quality gate."""


class SuiteError(ValueError):
    """Raised for a suite document that cannot be understood."""


# Names of the rule types, fixed values shared with suite documents.
ORDERED_COLUMNS = "expect_table_columns_to_match_ordered_list"
COLUMNS_EXIST = "expect_table_columns_to_exist"
ROW_COUNT = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
GREATER = "expect_column_pair_values_A_to_be_greater_than_B"
REGEX = "expect_column_values_to_match_regex"
PARSEABLE = "expect_column_values_to_be_dateutil_parseable"

TABLE_RULES = {ORDERED_COLUMNS, COLUMNS_EXIST, ROW_COUNT}


@dataclass(frozen=True)
class Rule:
    """One expectation. ``mostly`` is the least share of considered rows that must comply."""

    kind: str
    column: str | None = None
    mostly: float = 1.0
    args: dict[str, Any] = field(default_factory=dict)

    def columns(self) -> list[str]:
        """Columns a row-level rule reads."""
        named = [self.column, self.args.get("column_A"), self.args.get("column_B")]
        bounds = [_parameter(self.args.get(b)) for b in ("min_value", "max_value")]
        return [c for c in [*named, *bounds] if c]


@dataclass(frozen=True)
class Suite:
    name: str
    rules: tuple[Rule, ...]


def between(column: str, low: Any = None, high: Any = None, mostly: float = 0.99) -> Rule:
    return Rule(BETWEEN, column, mostly, {"min_value": low, "max_value": high})


def not_null(column: str) -> Rule:
    return Rule(NOT_NULL, column)


def high_not_below_low(mostly: float) -> Rule:
    args = {"column_A": "high_price", "column_B": "low_price", "or_equal": True}
    return Rule(GREATER, None, mostly, args)


def row_count(low: int = 1, high: int | None = 50_000) -> Rule:
    return Rule(ROW_COUNT, args={"min_value": low, "max_value": high})


def column_bound(column: str) -> dict[str, str]:
    """A bound taken from another column of the same row."""
    return {"$PARAMETER": column}


# Fixed rule values of the full suite (17 rules).
FULL_SUITE = Suite(
    "stock_data_quality_suite",
    (
        Rule(ORDERED_COLUMNS, args={"column_list": RAW_COLUMNS}),
        not_null("symbol"),
        not_null("timestamp"),
        not_null("close_price"),
        between("open_price", 0, 1_000_000),
        between("high_price", 0, 1_000_000),
        between("low_price", 0, 1_000_000),
        between("close_price", 0, 1_000_000),
        between("volume", 0, mostly=0.95),
        high_not_below_low(mostly=0.99),
        between("open_price", column_bound("low_price"), column_bound("high_price")),
        between("close_price", column_bound("low_price"), column_bound("high_price")),
        Rule(REGEX, "symbol", 0.99, {"regex": "^[A-Z]{1,5}$"}),
        Rule(PARSEABLE, "timestamp"),
        row_count(),
        between("split_coefficient", 0, 100),
        between("dividend_amount", 0),
    ),
)

# Fixed rule values of the core suite (11 rules): no upper price bound, strict high >= low.
CORE_SUITE = Suite(
    "core_suite",
    (
        Rule(
            COLUMNS_EXIST,
            args={"column_list": [c for c in RAW_COLUMNS if c not in
                                  ("adjusted_close", "dividend_amount", "split_coefficient")]},
        ),
        not_null("symbol"),
        not_null("timestamp"),
        not_null("close_price"),
        between("high_price", 0),
        between("low_price", 0),
        between("open_price", 0),
        between("close_price", 0),
        between("volume", 0),
        high_not_below_low(mostly=1.0),
        row_count(),
    ),
)


def load_suite(document: str | dict[str, Any]) -> Suite:
    """A suite from its JSON document: a name and a list of types with keyword arguments."""
    parsed = json.loads(document) if isinstance(document, str) else document
    rules = []
    for entry in parsed.get("expectations", []):
        kwargs = dict(entry.get("kwargs", {}))
        kind = entry["expectation_type"]
        if kind not in TABLE_RULES | {NOT_NULL, BETWEEN, GREATER, REGEX, PARSEABLE}:
            raise SuiteError(f"unknown expectation type {kind!r}")
        rules.append(Rule(kind, kwargs.pop("column", None), kwargs.pop("mostly", 1.0), kwargs))
    return Suite(parsed.get("expectation_suite_name", "suite"), tuple(rules))


def evaluate(df: DataFrame, suite: Suite, by: Iterable[str] = ()) -> DataFrame:
    """One row per rule (and per group of ``by``) with its outcome and counters.

    NULLs are not considered, and a rule without any row to consider holds. A rule on a
    column the data lacks fails.
    """
    by = list(by)
    columns = [c for c in df.columns if c not in by or c in RAW_COLUMNS]
    counters = [F.count("*").alias("_rows")]
    for i, rule in enumerate(suite.rules):
        if rule.kind in TABLE_RULES or _missing(rule, columns):
            continue
        considered, violated = _counted(rule)
        counters.append(F.count_if(considered).alias(f"_considered_{i}"))
        counters.append(F.count_if(considered & violated).alias(f"_violations_{i}"))
    counted = df.groupBy(*by).agg(*counters) if by else df.agg(*counters)
    outcomes = [_outcome(i, rule, columns) for i, rule in enumerate(suite.rules)]
    return counted.select(*by, F.inline(F.array(*outcomes)))


def _parameter(bound: Any) -> str | None:
    return bound.get("$PARAMETER") if isinstance(bound, dict) else None


def _bound(bound: Any) -> Column:
    return F.col(_parameter(bound)) if isinstance(bound, dict) else F.lit(bound)


def _missing(rule: Rule, columns: list[str]) -> list[str]:
    return [c for c in rule.columns() if c not in columns]


def _counted(rule: Rule) -> tuple[Column, Column]:
    """Which rows a rule considers, and which of them violate it."""
    if rule.kind == NOT_NULL:
        return F.lit(True), F.col(rule.column).isNull()
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.columns()])
    if rule.kind == BETWEEN:
        value, low, high = F.col(rule.column), rule.args.get("min_value"), rule.args.get("max_value")
        outside = F.lit(False)
        if low is not None:
            outside = outside | (value < _bound(low))
        if high is not None:
            outside = outside | (value > _bound(high))
        return present, outside
    if rule.kind == GREATER:
        a, b = F.col(rule.args["column_A"]), F.col(rule.args["column_B"])
        return present, (a < b) if rule.args.get("or_equal") else (a <= b)
    if rule.kind == REGEX:
        return present, ~F.col(rule.column).rlike(rule.args["regex"])
    return present, parseable_timestamp(rule.column).isNull()


def _outcome(i: int, rule: Rule, columns: list[str]) -> Column:
    missing = _missing(rule, columns)
    considered = violations = F.lit(None).cast("long")
    if rule.kind in (ORDERED_COLUMNS, COLUMNS_EXIST):
        wanted = rule.args["column_list"]
        absent = [c for c in wanted if c not in columns]
        held = columns == wanted if rule.kind == ORDERED_COLUMNS else not absent
        success = F.lit(held)
        details = {
            "required_columns": F.array(*[F.lit(c) for c in wanted]),
            "missing_columns": F.array(*[F.lit(c) for c in absent]).cast("array<string>"),
        }
    elif rule.kind == ROW_COUNT:
        low, high = rule.args.get("min_value"), rule.args.get("max_value")
        success = F.lit(True)
        if low is not None:
            success = success & (F.col("_rows") >= low)
        if high is not None:
            success = success & (F.col("_rows") <= high)
        considered = F.col("_rows")
        details = {
            "row_count": F.col("_rows"),
            "min_expected": F.lit(low).cast("long"),
            "max_expected": F.lit(high).cast("long"),
        }
    elif missing:
        success = F.lit(False)
        details = {"error": F.lit(f"Column not found: {', '.join(missing)}")}
    else:
        considered, violations = F.col(f"_considered_{i}"), F.col(f"_violations_{i}")
        success = _share(considered, violations) >= rule.mostly
        if rule.kind == NOT_NULL:
            details = {
                "null_count": violations,
                "total_count": considered,
                "null_percentage": F.round((1 - _share(considered, violations)) * 100, 2),
            }
        else:
            details = {
                "violations": violations,
                "total_values": considered,
                "success_rate": F.round(_share(considered, violations), 4),
                "required_success_rate": F.lit(float(rule.mostly)),
            }
    named = rule.column or ",".join(c for c in rule.columns())
    return F.struct(
        F.lit(i + 1).alias("rule_no"),
        F.lit(rule.kind).alias("expectation_type"),
        F.lit(named or None).cast("string").alias("column_name"),
        success.alias("success"),
        considered.alias("considered"),
        violations.alias("violations"),
        F.round(_share(considered, violations), 4).alias("success_rate"),
        F.to_json(F.struct(*[c.alias(n) for n, c in details.items()])).alias("details"),
    )


def _share(considered: Column, violations: Column) -> Column:
    return F.when(considered > 0, 1 - violations / considered).when(considered == 0, F.lit(1.0))


def report(results: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Totals of a suite run: rules evaluated, passed, failed, success and the failures."""
    by = list(by)
    failure = F.when(
        ~F.col("success"), F.struct("rule_no", "expectation_type", "column_name", "details")
    )
    grouped = results.groupBy(*by) if by else results.groupBy()
    # The list holds at most one entry per rule of the suite.
    return grouped.agg(
        F.count("*").alias("evaluated_expectations"),
        F.count_if("success").alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
        F.every("success").alias("success"),
        F.array_sort(F.collect_list(failure)).alias("failed_expectations"),
    )


def verdict(file_reports: DataFrame) -> DataFrame:
    """One row over all files: how many passed and failed, and whether all passed."""
    return file_reports.agg(
        F.count("*").alias("files"),
        F.count_if("success").alias("passed_files"),
        F.count_if(~F.col("success")).alias("failed_files"),
        F.coalesce(F.every("success"), F.lit(False)).alias("overall_success"),
    )


def gate(results: DataFrame, max_failed_ratio: float = 0.0) -> dict[str, int]:
    """Let data through, or raise with the first failures.

    By default a single failed rule blocks; ``max_failed_ratio`` tolerates a share of them.
    """
    totals = results.agg(F.count("*").alias("n"), F.count_if(~F.col("success")).alias("failed")).first()
    if totals["n"] == 0:
        raise QualityGateError("nothing was validated")
    if totals["failed"] > max_failed_ratio * totals["n"]:
        first = results.filter(~F.col("success")).limit(20).collect()
        lines = "\n".join(f"  {r['expectation_type']} {r['column_name']}: {r['details']}" for r in first)
        raise QualityGateError(f"{totals['failed']} of {totals['n']} checks failed:\n{lines}")
    return {"evaluated": totals["n"], "failed": totals["failed"]}


def errors_of_row(suite: Suite, columns: list[str]) -> Column:
    """Whether a row violates any row-level rule of the suite."""
    broken = [
        F.coalesce(considered & violated, F.lit(False))
        for rule in suite.rules
        if rule.kind not in TABLE_RULES and not _missing(rule, columns)
        for considered, violated in [_counted(rule)]
    ]
    return reduce(lambda a, b: a | b, broken, F.lit(False))


def summary_by_symbol(df: DataFrame, suite: Suite = FULL_SUITE) -> DataFrame:
    """Per symbol and overall (symbol NULL, ``is_total`` 1): rows, rows in error, pass rate."""
    flagged = df.select("symbol", errors_of_row(suite, df.columns).alias("_error"))
    counted = flagged.rollup("symbol").agg(
        F.grouping("symbol").cast("int").alias("is_total"),
        F.count("*").alias("records_validated"),
        F.count_if("_error").alias("errors"),
    )
    passed = 1 - F.col("errors") / F.col("records_validated")
    return counted.withColumn(
        "pass_rate", F.when(F.col("records_validated") > 0, F.round(passed, 4))
    )


def check_fact(df: DataFrame) -> DataFrame:
    """Fact rows must have a close, and it must not be negative."""
    close = F.col("close_price")
    return df.agg(
        F.count_if(close.isNull()).alias("null_close"),
        F.count_if(close < 0).alias("negative_close"),
    ).withColumn("success", (F.col("null_close") == 0) & (F.col("negative_close") == 0))


def check_ohlc(df: DataFrame) -> DataFrame:
    """Full bar relation: low <= open, close <= high, over rows that have all four."""
    low, high = F.col("low_price"), F.col("high_price")
    prices = [F.col("open_price"), F.col("close_price"), low, high]
    present = reduce(lambda a, b: a & b, [p.isNotNull() for p in prices])
    broken = (high < low) | ~F.col("open_price").between(low, high) | ~F.col("close_price").between(low, high)
    return df.agg(
        F.count_if(present).alias("considered"), F.count_if(present & broken).alias("violations")
    ).withColumn("success", F.col("violations") == 0)


def check_return_behaviour(log_returns: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Per symbol: skewness of log returns, greatest move, lowest price, and the three verdicts.

    Expects ``log_return``, ``change`` (fraction of the previous close) and ``close_price``.
    """
    n, biased = F.count("log_return"), F.skewness("log_return")
    adjusted = F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * biased)
    move = F.max(F.abs("change"))
    return log_returns.groupBy(symbol).agg(
        n.alias("returns"),
        F.round(adjusted, 6).alias("log_return_skewness"),
        F.round(move, 6).alias("greatest_move"),
        F.min("close_price").alias("lowest_close"),
        (F.abs(adjusted) < 2.0).alias("skewness_ok"),
        (move < 0.5).alias("returns_ok"),
        (move < 0.2).alias("jumps_ok"),
        F.every(F.col("close_price") > 0).alias("prices_positive"),
    )
