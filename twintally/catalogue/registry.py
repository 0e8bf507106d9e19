"""Registered queries: a Spark callable and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register the decorated callable under ``name``, with its SQL counterpart."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        ORACLE_SQL[name] = sql.strip()
        return build

    return register
