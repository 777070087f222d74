"""The queries of this package with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from seqspark.session import ship_package

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with SQL of equal meaning where there is one."""

    def add(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf_dir)

        LLM_QUERIES[name] = run
        if sql is not None:
            LLM_ORACLES[name] = sql
        return function

    return add
