"""Queries that are checked against SQL on the given tables.

Each function takes (spark, folder of the tables) and returns a DataFrame; the
SQL beside it states the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL of its result if there is one."""

    def keep(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return keep


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_all() -> None:
    """Import the modules that register queries."""
    from registered import aggregates, expressions, joins, keys, landed, quality, star, warehouse  # noqa: F401
