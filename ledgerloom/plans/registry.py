"""All registered queries of the library, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import SQL, Views

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of ``Views`` under its name, with the same query in SQL over the views' names."""

    def add(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            _SQL[f.__name__] = f"WITH {SQL.strip()}{', ' if sql.lstrip().startswith('+') else ' '}{sql.lstrip().removeprefix('+')}"
        return f

    return add


def _load() -> None:
    from . import document_queries, feed_queries, planning_queries, quality_queries, store_queries, suite_queries, table_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debt-to-equity style ratios of all companies."""
    return queries()["ratio_pivot"](spark, sf_dir)
