"""Named queries over the provided tables, each with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; without SQL it is checked by the tests instead."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    from lodestone.plans import (  # noqa: F401  (importing registers)
        queries_classifier,
        queries_corpus,
        queries_evaluation,
        queries_monitoring,
        queries_search,
        queries_sources,
    )
