"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The tables of a folder, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
        """Registers a function of the tables under its name; ``sql`` gives the same rows in DuckDB."""

        def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
            self.queries[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add
