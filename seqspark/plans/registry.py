"""Registry of named queries with their SQL of equal meaning."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from seqspark.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` its result is not expressible (or too slow) in SQL."""

    def add(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add
