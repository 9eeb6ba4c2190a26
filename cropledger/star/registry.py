"""Registered queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cropledger.star.sql import with_fragments

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may mention the fragments of ``star.sql``."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = with_fragments(sql)
        return function

    return register
