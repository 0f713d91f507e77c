"""Registered queries of the engine: name -> plan, and the SQL each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Decorator: add a query and, where there is one, its SQL."""

    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _ORACLES[name] = sql
        return f

    return add


def _load() -> None:
    from graniteloom.plans import catalog, states  # noqa: F401  register on import


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar chunks by their hashes, scored and ranked per source."""
    return queries()["hash_match_topk"](spark, sf_dir)
