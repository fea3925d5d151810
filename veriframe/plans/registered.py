"""Registry of the comparison queries: a Spark query and, where possible, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a key, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        QUERIES[key] = function
        if sql is not None:
            SQL[key] = sql
        return function

    return register
