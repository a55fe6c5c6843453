"""Queries by name, each with the SQL that must give the same rows, if SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def checked(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL."""

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def with_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_settings(spark)
            return query(spark, sf_dir)

        QUERIES[name] = with_settings
        if sql is not None:
            ORACLE[name] = sql
        return query

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries and their SQL."""
    from tickloom.plans import (  # noqa: F401
        check_cleansing,
        check_indicators,
        check_jobs,
        check_quality,
        check_reports,
        check_sinks,
        check_sources,
    )

    return dict(QUERIES), dict(ORACLE)
