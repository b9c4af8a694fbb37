"""Queries over the given tables, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from feedloom.session import tune


@dataclass
class Tables:
    """The given tables of one directory, read on demand."""

    spark: SparkSession
    root: str

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A given table dealt over the session's shuffle partitions.

        Tables of short rows fill few splits; where much is made of each row, a task per split would do all of it.
        """
        return getattr(self, name).repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL it is checked by tests against brute force instead."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def bound(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Tables(tune(spark), sf_dir))
