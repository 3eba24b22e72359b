"""The queries of the modules beside this one, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, d, f=f: f(lambda name: spark.read.parquet(f"{d}/{name}.parquet"))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add
