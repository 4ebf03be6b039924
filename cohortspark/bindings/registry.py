"""Named queries on the test tables, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Lazily opened test tables: ``t.orders`` reads ``orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        QUERIES[name].__name__ = name
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def rnd(c: Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    return F.round(c.cast("double"), digits) + F.lit(0.0)
