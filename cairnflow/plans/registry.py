"""Every registered query by name, with its DuckDB statement where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function under ``name``; ``sql`` is its DuckDB counterpart."""

    def keep(build):
        QUERIES[name] = build
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return keep
