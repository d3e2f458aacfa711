"""Named queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is its counterpart, if SQL can express it."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """The named columns of a given table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)
