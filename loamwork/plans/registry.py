"""All registered queries of the document-analytics operators, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "topic_keywords"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query (spark, sf_dir) -> DataFrame, with SQL where it can be expressed."""

    def add(f):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def sql_of(name: str) -> str:
    """The SQL of a query that is already registered, to build others on."""
    return _SQL[name]


def _load() -> None:
    from loamwork.plans import (  # noqa: F401  (they register themselves)
        acquisition,
        assessment,
        companies,
        documents,
        file_plans,
        filings,
        layout,
        lines,
        matching,
        preprocessing,
        sections,
        topic_models,
        topic_tables,
        topic_vectors,
        topics,
    )
    from loamwork.streaming import attempts  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
