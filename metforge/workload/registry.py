"""Where queries and their SQL equivalents are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metforge.workload.views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = with_views(sql, *views) if views else sql.strip()
        return fn

    return register
