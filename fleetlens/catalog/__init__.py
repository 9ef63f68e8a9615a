"""Every operator as a named query over the given tables, with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlens.session import tune

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, and the equivalent SQL where the operator can be stated in SQL."""

    def register(fn: Query) -> Query:
        _QUERIES[name] = lambda spark, folder: fn(tune(spark), folder)
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def _load() -> None:
    from fleetlens.catalog import drift, evaluation, features, gold, ingest, learning, quality  # noqa: F401


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
