"""The table reader and the register that the query modules fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cuadra.session import adapt


class Tables:
    """The tables of one data folder, read on first use: ``t.orders`` is the orders table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._schemas = adapt(spark), folder, {}

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)


Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` as a query, with the SQL that must give the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            SQL[key] = sql
        return fn

    return register
