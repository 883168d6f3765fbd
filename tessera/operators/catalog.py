"""Introspection, schema differences, plans and capabilities."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: SQL type names and the Spark type of each (fixed values).
TYPES = {
    "int": "int", "integer": "int", "bigint": "bigint", "smallint": "smallint", "tinyint": "smallint", "bit": "boolean",
    "float": "double", "real": "float", "decimal": "decimal", "numeric": "decimal", "money": "decimal(19,4)", "smallmoney": "decimal(10,4)",
    "varchar": "string", "nvarchar": "string", "char": "string", "nchar": "string", "text": "string", "ntext": "string", "xml": "string",
    "uniqueidentifier": "string", "hierarchyid": "string", "geometry": "string", "geography": "string",
    "datetime": "timestamp_ntz", "datetime2": "timestamp_ntz", "smalldatetime": "timestamp_ntz", "datetimeoffset": "timestamp", "date": "date", "time": "string",
    "varbinary": "binary", "binary": "binary", "image": "binary",
}


def parse_type(text: str) -> str:
    """Spark type of a SQL type text; an unknown one raises."""
    m = re.fullmatch(r"\s*(\w+)\s*(?:\(([^)]*)\))?\s*", text)
    name = m[1].lower() if m else ""
    if name not in TYPES:
        raise ValueError(f"unknown type {text}")
    return f"decimal({m[2] or '18,0'})" if TYPES[name] == "decimal" else TYPES[name]


def columns(df: DataFrame) -> list[tuple[int, str, str, bool]]:
    """(ordinal, name, type, nullable)."""
    return [(k, f.name, f.dataType.simpleString(), f.nullable) for k, f in enumerate(df.schema.fields, 1)]


def columns_table(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    rows = [(t, *c) for t, df in tables.items() for c in columns(df)]
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, data_type string, nullable boolean")


def schema_diff(old: T.StructType, new: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(change, column, old, new); another ordinal is a modification."""
    was = {f.name: (k, f.dataType.simpleString(), f.nullable) for k, f in enumerate(old.fields)}
    now = {f.name: (k, f.dataType.simpleString(), f.nullable) for k, f in enumerate(new.fields)}
    text = lambda x: f"{x[0]} {x[1]} {'null' if x[2] else 'not null'}"
    out = [("removed", n, text(was[n]), None) for n in was if n not in now]
    out += [("added", n, None, text(now[n])) for n in now if n not in was]
    return out + [("modified", n, text(was[n]), text(now[n])) for n in was if n in now and was[n] != now[n]]


def diff_tables(old: dict[str, T.StructType], new: dict[str, T.StructType]) -> list[tuple[str, str, str, str | None, str | None]]:
    """(change, table, column, old, new) of two whole schemas; a table that came or went is one row without a column."""
    out = [("removed", t, "", None, None) for t in old if t not in new] + [("added", t, "", None, None) for t in new if t not in old]
    return out + [(change, t, name, was, now) for t in old if t in new for change, name, was, now in schema_diff(old[t], new[t])]


def tables(spark: SparkSession, schema: str) -> list[tuple[str, str]]:
    """(name, kind) of a schema's tables and views."""
    return sorted((t.name, "VIEW" if t.tableType == "VIEW" else "BASE TABLE") for t in spark.catalog.listTables(schema) if not t.isTemporary)


def table_detail(spark: SparkSession, name: str) -> dict[str, object]:
    """Columns, provider, key and row count of a table."""
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    df = spark.table(name)
    return {"columns": columns(df), "provider": facts.get("Provider"), "keys": [k for k in properties.get("primary_key", "").split(",") if k], "rows": df.count()}


def show(spark: SparkSession, what: str, name: str) -> DataFrame:
    """SHOW TABLES, VIEWS, COLUMNS or CREATE TABLE of a schema or table."""
    statements = {"tables": "SHOW TABLES IN {}", "views": "SHOW VIEWS IN {}", "columns": "SHOW COLUMNS IN {}", "create": "SHOW CREATE TABLE {}"}
    return spark.sql(statements[what].format(name))


def plan(df: DataFrame, mode: str = "formatted") -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def plan_summary(df: DataFrame) -> dict[str, int]:
    """How often each physical operator stands in the plan."""
    out: dict[str, int] = {}
    for name in re.findall(r"^\((\d+)\) ([A-Z]\w+)", plan(df), re.M):
        out[name[1]] = out.get(name[1], 0) + 1
    return out


def capabilities() -> dict[str, bool]:
    """What the engine offers, by feature family."""
    yes = "ctes recursive_ctes windows window_frames rollup cube grouping_sets lateral_join merge upsert returning pivot unpivot set_operations json_functions full_text collation offset_fetch table_sample try_cast views schemas partition_ranges explain introspection scalar_udf table_udf aggregate_udf filter_clause ordered_set_aggregates qualify_by_subquery".split()
    no = "transactions savepoints row_locks triggers enforced_constraints indexes stored_procedures graph_match materialized_views".split()
    return dict.fromkeys(yes, True) | dict.fromkeys(no, False)
