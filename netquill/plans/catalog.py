"""The catalogue that query modules register in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame, and the SQL that must give the same rows."""

    def put(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return put
