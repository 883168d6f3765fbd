"""Parent and child navigation as set-based joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def belongs_to(child: DataFrame, parent: DataFrame, foreign_key: str, key: str, name: str) -> DataFrame:
    """Adds the parent as a struct; null for a null or orphaned key."""
    held = parent.select(F.col(key).alias("__key"), F.struct(*parent.columns).alias(name))
    return child.join(held, child[foreign_key] == F.col("__key"), "left").drop("__key")


def has_many(parent: DataFrame, child: DataFrame, foreign_key: str, key: str, name: str, where: Column | None = None) -> DataFrame:
    """Eager loading: adds the children as a sorted array of structs, empty where there are none."""
    child = child if where is None else child.where(where)
    held = child.groupBy(F.col(foreign_key).alias("__key")).agg(F.array_sort(F.collect_list(F.struct(*child.columns))).alias(name))
    kind = held.schema[name].dataType
    out = parent.join(held, parent[key] == F.col("__key"), "left").drop("__key")
    return out.withColumn(name, F.coalesce(F.col(name), F.array().cast(kind)))


def has_one(parent: DataFrame, child: DataFrame, foreign_key: str, key: str, name: str, lowest: str) -> DataFrame:
    """Adds the child with the lowest value of a column, of several that match."""
    held = child.groupBy(F.col(foreign_key).alias("__key")).agg(F.min_by(F.struct(*child.columns), F.col(lowest)).alias(name))
    return parent.join(held, parent[key] == F.col("__key"), "left").drop("__key")
