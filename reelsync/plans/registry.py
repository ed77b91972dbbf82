"""Registry of named queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn`` as query ``name``; ``sql`` is its DuckDB oracle, or
    ``None`` when the semantics are not expressible as one SQL statement."""
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco
