"""Query building on DataFrames: joins, apply, grouping sets, pivots, paging, set operations."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import UnsupportedFeatureError

#: Join hints of the dialect and what they ask Spark for.
JOIN_HINTS = {"hash": "shuffle_hash", "loop": "shuffle_replicate_nl", "merge": "merge"}


def join(left: DataFrame, right: DataFrame, on: Column | Sequence[str] | str, how: str = "inner", hint: str | None = None) -> DataFrame:
    return left.join(right.hint(JOIN_HINTS[hint.lower()]) if hint else right, on, how)


def cross_apply(left: DataFrame, right: DataFrame) -> DataFrame:
    """``right`` may use columns of ``left`` by ``F.col(name).outer()``."""
    return left.lateralJoin(right)


def outer_apply(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.lateralJoin(right, how="left")


def pivot(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, aggregate: Column) -> DataFrame:
    if not values:
        raise ValueError("a pivot needs at least one value")
    return df.groupBy(*keys).pivot(column, list(values)).agg(aggregate)


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Nulls are dropped."""
    return df.unpivot(list(keys), list(columns), name, value).where(F.col(value).isNotNull())


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], *aggregates: Column) -> DataFrame:
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(*aggregates)


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_percent(df: DataFrame, percent: float, *order: str, descending: bool = True) -> DataFrame:
    """The first ceil(percent * rows / 100) rows: a count, then one top-n."""
    n = -(-df.count() * percent // 100)
    return df.orderBy(*[F.desc(c) if descending else F.asc(c) for c in order]).limit(int(n))


def page(df: DataFrame, offset: int, fetch: int | None = None) -> DataFrame:
    out = df.offset(offset) if offset else df
    return out if fetch is None else out.limit(fetch)


def top_per_group(df: DataFrame, keys: Sequence[str], n: int, *order: Column) -> DataFrame:
    """QUALIFY row_number() <= n; Spark limits groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def set_operation(kind: str, left: DataFrame, right: DataFrame, all_rows: bool = False) -> DataFrame:
    operations: dict[tuple[str, bool], Callable[[], DataFrame]] = {
        ("union", False): lambda: left.union(right).distinct(),
        ("union", True): lambda: left.union(right),
        ("intersect", False): lambda: left.intersect(right),
        ("intersect", True): lambda: left.intersectAll(right),
        ("except", False): lambda: left.subtract(right),
        ("except", True): lambda: left.exceptAll(right),
    }
    if (kind, all_rows) not in operations:
        raise UnsupportedFeatureError(f"set operation {kind}")
    return operations[kind, all_rows]()


def max_parallel(df: DataFrame, degree: int) -> DataFrame:
    """MAXDOP: at most so many tasks work on what follows, up to its next shuffle."""
    return df.coalesce(degree)
