"""Table access for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """``Tables(spark, dir).orders`` reads ``dir/orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


class Registry(dict):
    """``@registry.add(sql)`` registers a query builder taking :class:`Tables` under its own name."""

    def __init__(self) -> None:
        super().__init__()
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def keep(fn):
            self[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
            if sql is not None:
                self.oracles[fn.__name__] = sql
            return fn

        return keep
