"""Schemas, tables and views in Spark's catalogue.

Names are the developer's, checked to be plain identifiers. Tables are Parquet; a change that Parquet tables don't take in
place writes the new content beside the old and renames it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import parse_type

_NAME = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)?")


def checked(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"bad name {name}")
    return name


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {checked(name)}")


def drop_schema(spark: SparkSession, name: str, cascade: bool = False) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS {checked(name)} {'CASCADE' if cascade else 'RESTRICT'}")


def create_table(spark: SparkSession, name: str, fields: dict[str, str], keys: Sequence[str] = (), partition_by: Sequence[str] = (), if_not_exists: bool = False) -> None:
    """``fields``: SQL types by name. Keys are kept as a property: Spark doesn't enforce them."""
    listed = ", ".join(f"{checked(n)} {parse_type(t)}" for n, t in fields.items())
    parts = f" PARTITIONED BY ({', '.join(map(checked, partition_by))})" if partition_by else ""
    more = f" TBLPROPERTIES ('primary_key' = '{','.join(map(checked, keys))}')" if keys else ""
    spark.sql(f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{checked(name)} ({listed}) USING parquet{parts}{more}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {checked(name)}")


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {checked(name)}")


def add_columns(spark: SparkSession, name: str, fields: dict[str, str]) -> None:
    """New columns, null in the rows that are there."""
    spark.sql(f"ALTER TABLE {checked(name)} ADD COLUMNS ({', '.join(f'{checked(n)} {parse_type(t)}' for n, t in fields.items())})")


def _replace(spark: SparkSession, name: str, df: DataFrame) -> None:
    keys = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get("primary_key")
    new = f"{checked(name)}__new"
    drop_table(spark, new)
    df.write.format("parquet").saveAsTable(new)
    if keys and set(keys.split(",")) <= set(df.columns):
        spark.sql(f"ALTER TABLE {new} SET TBLPROPERTIES ('primary_key' = '{keys}')")
    drop_table(spark, name)
    spark.sql(f"ALTER TABLE {new} RENAME TO {name}")


def drop_columns(spark: SparkSession, name: str, columns: Sequence[str]) -> None:
    _replace(spark, name, spark.table(name).drop(*columns))


def alter_column(spark: SparkSession, name: str, column: str, kind: str) -> None:
    """Another type; a value that doesn't fit raises."""
    _replace(spark, name, spark.table(name).withColumn(column, F.col(column).cast(parse_type(kind))))


def rename_column(spark: SparkSession, name: str, old: str, new: str) -> None:
    _replace(spark, name, spark.table(name).withColumnRenamed(old, checked(new)))


def create_view(spark: SparkSession, name: str, query: str, replace: bool = False) -> None:
    spark.sql(f"CREATE {'OR REPLACE ' if replace else ''}VIEW {checked(name)} AS {query}")


def drop_view(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {checked(name)}")


def materialise(spark: SparkSession, view: str, table: str) -> None:
    """What an indexed view keeps: its rows as a table, computed anew by each call."""
    spark.table(checked(view)).write.format("parquet").mode("overwrite").saveAsTable(checked(table))


def generated(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """PERSISTED computed columns, to be written with the rows; a caller's own values for them are replaced."""
    return df.drop(*columns).select("*", *[v.alias(n) for n, v in columns.items()])


def switch_partition(spark: SparkSession, source: DataFrame, target: str) -> None:
    """Puts the partitions that ``source`` holds in place of the target's; its other partitions stay."""
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        source.select(*spark.table(checked(target)).columns).write.insertInto(target, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def split_range(bounds: Sequence, at: object) -> list:
    """Bounds of a range partition function with one more."""
    if at in bounds:
        raise ValueError(f"{at} is a bound already")
    return sorted([*bounds, at])


def merge_range(bounds: Sequence, at: object) -> list:
    """Bounds of a range partition function with one less."""
    if at not in bounds:
        raise ValueError(f"{at} is no bound")
    return [b for b in bounds if b != at]


def drop_function(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {checked(name)}")
