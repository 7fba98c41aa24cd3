"""Registry of the publication-analytics queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL that must return the same rows."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[name] = build
        if sql is not None:
            _ORACLES[name] = sql
        return build

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    """Import the query modules, which register themselves."""
    from folioscope.plans import queries_text, queries_tables  # noqa: F401
