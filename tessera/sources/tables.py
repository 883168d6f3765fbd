"""Sources and sinks."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.strings import string_split


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc_options(host: str, database: str, port: int = 1433, driver: str | None = None, **more: str) -> dict[str, str]:
    """Options of ``spark.read.format("jdbc")`` for a server; the driver's jar is the user's."""
    options = {"url": f"jdbc:sqlserver://{host}:{port};databaseName={database}"} | more
    return options | ({"driver": driver} if driver else {})


def jdbc_read(spark: SparkSession, options: dict[str, str], table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8) -> DataFrame:
    """A table over JDBC; with a numeric key and its bounds, read in ``parts`` ranges by as many tasks."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
    return reader.load()


def jdbc_write(df: DataFrame, options: dict[str, str], table: str, mode: str = "append") -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).mode(mode).save()


def execute(spark: SparkSession, sql: str, parameters: Sequence[object] = ()) -> DataFrame:
    """One statement with ``?`` markers; values are bound, never pasted."""
    return spark.sql(sql, args=list(parameters)) if parameters else spark.sql(sql)


def execute_many(spark: SparkSession, rows: Iterable[Sequence], schema: str, statement: str, name: str = "batch") -> DataFrame:
    """One statement over a list of parameter rows, which it sees as the view ``name``; an empty list gives what the
    statement gives for no row."""
    values(spark, rows, schema).createOrReplaceTempView(name)
    return spark.sql(statement)


def split_script(script: str) -> list[str]:
    """Batches between lines that hold only GO."""
    return [b.strip() for b in re.split(r"(?im)^[ \t]*GO[ \t]*$", script) if b.strip()]


def execute_script(spark: SparkSession, script: str) -> list[DataFrame]:
    return [spark.sql(batch) for batch in split_script(script)]


def values(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def default_values(spark: SparkSession, schema: str, defaults: dict[str, object] | None = None, n: int = 1) -> DataFrame:
    """DEFAULT VALUES: rows of each column's default, null where it has none."""
    fields = spark.createDataFrame([], schema).schema
    given = defaults or {}
    return spark.range(n).select(*[F.lit(given.get(f.name)).cast(f.dataType).alias(f.name) for f in fields])


def openjson(df: DataFrame, column: str, schema: dict[str, tuple[str, str]] | None = None, path: str = "$") -> DataFrame:
    """Rows of a JSON array or members of an object, beside the other columns.

    With a schema (name -> (type, path in the element)) one typed column each; without, (key, value).
    """
    if schema is None:
        part = F.try_variant_get(F.try_parse_json(F.col(column)), path, "variant")
        keyed = df.withColumn("__part", part).lateralJoin(df.sparkSession.tvf.variant_explode(F.col("__part").outer()))
        key = F.coalesce(F.col("key"), F.col("pos").cast("string"))
        value = F.coalesce(F.expr("try_variant_get(value, '$', 'string')"), F.to_json("value"))
        return keyed.select(*df.columns, key.alias("json_key"), value.alias("json_value"))
    array = F.from_json(F.get_json_object(F.col(column), path), "array<string>")
    rows = df.withColumn("__item", F.explode(array))
    return rows.select(*df.columns, *[F.get_json_object("__item", p).try_cast(t).alias(n) for n, (t, p) in schema.items()])


def split_rows(df: DataFrame, column: str, sep: str) -> DataFrame:
    """STRING_SPLIT as a row source: (value, ordinal) beside the other columns."""
    return df.select(*df.columns, F.posexplode(string_split(F.col(column), sep)).alias("ordinal", "value")).withColumn("ordinal", (F.col("ordinal") + 1).cast("long"))


def tablesample(df: DataFrame, percent: float, seed: int | None = None) -> DataFrame:
    return df.sample(fraction=percent / 100, seed=seed)


def tablesample_rows(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """TABLESAMPLE n ROWS: those with the smallest hashes. Equal seeds give equal rows; every task sends ``n`` at most."""
    return df.orderBy(F.xxhash64(F.lit(seed), *df.columns)).limit(n)


def cycled(number: Column, low: int, high: int, increment: int = 1) -> Column:
    """Values of a CYCLE sequence between MINVALUE and MAXVALUE, from its running number (from 0)."""
    return F.lit(low) + F.pmod(number * F.lit(increment), F.lit(high - low + 1))


def next_value(df: DataFrame, order: Sequence[str], start: int = 1, increment: int = 1, name: str = "next_value") -> DataFrame:
    """A gapless number in the given order.

    Numbers within range-sorted partitions plus the partitions' offsets: no task sorts all rows.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    inside = Window.partitionBy("__part").orderBy(*order)
    counts = ordered.groupBy("__part").agg(F.count("*").alias("n"))
    # a row per partition
    before = counts.select(F.col("__part").alias("__p"), F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    numbered = ordered.withColumn("__n", F.row_number().over(inside)).join(F.broadcast(before), F.col("__part") == F.col("__p"))
    return numbered.withColumn(name, F.lit(start) + (F.col("__n") + F.col("__before") - 1) * increment).drop("__part", "__p", "__n", "__before")


def range_bucket(value: Column, bounds: Sequence, right: bool = False) -> Column:
    """Partition number (from 1) of a range partition function; RIGHT puts a bound in the upper part."""
    out = F.lit(len(bounds) + 1)
    for k in reversed(range(len(bounds))):
        out = F.when(value < F.lit(bounds[k]) if right else value <= F.lit(bounds[k]), k + 1).otherwise(out)
    return out


def write(df: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Sinks: parquet, json, csv or tsv files."""
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    {"parquet": writer.parquet, "json": writer.json, "csv": lambda p: writer.csv(p, header=True), "tsv": lambda p: writer.csv(p, header=True, sep="\t")}[kind](path)


def renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Column mapping: stored names to the names that the caller uses. Columns without an entry keep theirs."""
    return df.withColumnsRenamed(mapping)


def stored(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """The way back of ``renamed``."""
    return df.withColumnsRenamed({v: k for k, v in mapping.items()})


def select_into(df: DataFrame, table: str) -> None:
    df.write.saveAsTable(table)
