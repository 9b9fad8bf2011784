"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and,
where the operator is expressible in SQL, an independent DuckDB oracle text over
the same base tables (views inlined as CTEs)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a query builder under ``name`` with its oracle SQL."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


def with_ctes(*ctes: str, body: str) -> str:
    """``WITH a AS (...), b AS (...) <body>``."""
    return "WITH " + ",\n".join(ctes) + "\n" + body
