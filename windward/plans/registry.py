"""Registered queries: each a function (spark, sf_dir) -> DataFrame with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; without SQL it is checked by tests only."""
    def register(fn: Query) -> Query:
        QUERIES[name or fn.__name__] = fn
        if sql is not None:
            SQL[name or fn.__name__] = sql
        return fn
    return register
