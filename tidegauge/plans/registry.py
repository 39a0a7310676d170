"""Named queries, each with its DuckDB twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a ``(spark, sf_dir) -> DataFrame`` under ``name``."""

    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"two queries named {name}")
        _QUERIES[name] = fn
        if oracle:
            _ORACLE[name] = oracle
        return fn

    return add


def oracle_of(name: str) -> str:
    """The twin of a query registered before."""
    return _ORACLE[name]


def _load() -> None:
    from tidegauge.plans import features, finance, relational, rules, series, stages, statistics  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _ORACLE
