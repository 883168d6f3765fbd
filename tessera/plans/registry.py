"""Registered queries, each with the SQL that an independent engine answers it by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of a folder by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self._folder, name)


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__.rstrip("_")] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[f.__name__.rstrip("_")] = sql
        return f

    return register
