"""User-defined functions and a registry of named queries."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

_NAME = re.compile(r"[A-Za-z_]\w*")


def sql_function(spark: SparkSession, name: str, parameters: str, returns: str, body: str) -> None:
    """CREATE FUNCTION with a SQL body (the developer's text, never a user's)."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"bad name {name}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")


def vector_function(returns: str) -> Callable:
    """A scalar function over Arrow batches."""
    return lambda f: pandas_udf(f, returns)


def geometric_mean(value: Column) -> Column:
    """An aggregate function composed of built-in ones, which Spark reduces before the shuffle; values above 0 count."""
    return F.exp(F.avg(F.when(value > 0, F.ln(value))))


@pandas_udf(DoubleType())
def vector_geometric_mean(values: pd.Series) -> float:
    """The same as an Arrow function: for what built-in ones can't express, on groups that fit a worker, as it gets them whole."""
    import numpy as np

    positive = values[values > 0]
    return float(np.exp(np.log(positive).mean())) if len(positive) else None


class Procedures:
    """Named queries; steps of a graph get the results of those they depend on."""

    def __init__(self) -> None:
        self.steps: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {}

    def add(self, name: str, *after: str) -> Callable:
        def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            self.steps[name] = (f, after)
            return f

        return register

    def run(self, name: str, spark: SparkSession, done: dict[str, DataFrame] | None = None) -> DataFrame:
        done = {} if done is None else done
        if name not in done:
            f, after = self.steps[name]
            done[name] = f(spark, *[self.run(a, spark, done) for a in after])
        return done[name]
