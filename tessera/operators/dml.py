"""Changes as new snapshots, each with the rows its OUTPUT clause would give."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def insert(target: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = rows.select(*target.columns)
    return target.unionByName(rows), rows


def update(target: DataFrame, changes: dict[str, Column], where: Column) -> tuple[DataFrame, DataFrame]:
    """OUTPUT holds the columns of the old row as deleted_*, of the new one as inserted_*."""
    hit = F.coalesce(where, F.lit(False))
    new = target.select(*[F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in target.columns])
    old = target.where(hit)
    output = old.select(*[F.col(c).alias(f"deleted_{c}") for c in target.columns], *[changes.get(c, F.col(c)).alias(f"inserted_{c}") for c in target.columns])
    return new, output


def delete(target: DataFrame, where: Column) -> tuple[DataFrame, DataFrame]:
    hit = F.coalesce(where, F.lit(False))
    return target.where(~hit), target.where(hit)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_set: dict[str, Column] | None = None,
    delete_when: Column | None = None,
    insert_when: Column | None = None,
    update_when: Column | None = None,
    delete_unmatched_when: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(new snapshot, output with ``action``). Source columns other than keys are named ``src_<name>``
    in conditions and values; a source key found twice raises where it matches."""
    others = [c for c in source.columns if c not in keys]
    found = source.groupBy(*keys).agg(F.count("*").alias("__n"), *[F.first(c).alias(f"src_{c}") for c in others])
    old = target.select(*[F.col(c).alias(c) for c in target.columns], F.lit(True).alias("__old"))
    right = found.withColumnsRenamed({k: f"__{k}" for k in keys})
    both = old.join(right, [old[k] == right[f"__{k}"] for k in keys], "full")
    matched, fresh = F.col("__old") & F.col("__n").isNotNull(), F.col("__old").isNull()
    true = F.lit(True)
    ok = lambda c: F.coalesce(c, F.lit(False))
    action = F.when(matched & (F.col("__n") > 1), F.raise_error(F.lit("duplicate match in merge")))
    if delete_when is not None:
        action = action.when(matched & ok(delete_when), "DELETE")
    if update_set:
        action = action.when(matched & ok(true if update_when is None else update_when), "UPDATE")
    action = action.when(fresh & (F.col("__n") > 1), F.raise_error(F.lit("duplicate match in merge")))
    action = action.when(fresh & ok(true if insert_when is None else insert_when), "INSERT")
    if delete_unmatched_when is not None:
        action = action.when(F.col("__n").isNull() & ok(delete_unmatched_when), "DELETE")
    acted = both.withColumn("action", action)
    new = []
    for c in target.columns:
        inserted = F.col(f"__{c}") if c in keys else F.col(f"src_{c}") if c in others else F.lit(None).cast(target.schema[c].dataType)
        value = (update_set or {}).get(c, F.col(c))
        new.append(F.when(F.col("action") == "INSERT", inserted).when(F.col("action") == "UPDATE", value).otherwise(F.col(c)).alias(f"new_{c}"))
    rows = acted.select("action", "__old", *[F.col(c).alias(f"deleted_{c}") for c in target.columns], *new)
    snapshot = rows.where(F.coalesce(F.col("action") != "DELETE", F.col("__old"), F.lit(False))).select(*[F.col(f"new_{c}").alias(c) for c in target.columns])
    output = rows.where("action is not null").select("action", *[f"deleted_{c}" for c in target.columns], *[F.when(F.col("action") != "DELETE", F.col(f"new_{c}")).alias(f"inserted_{c}") for c in target.columns])
    return snapshot, output


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = {c: F.col(f"src_{c}") for c in source.columns if c not in keys}
    return merge(target, source, keys, update_set=values)[0]


def bulk_create(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Inserts many rows at once; one whose key is there already raises. OUTPUT holds the new rows."""
    missing = [c for c in target.columns if c not in rows.columns]
    rows = rows.select("*", *[F.lit(None).cast(target.schema[c].dataType).alias(c) for c in missing]).select(*target.columns)
    held = target.select(*keys, F.lit(True).alias("__there"))
    clash = F.when(F.col("__there"), F.raise_error(F.lit("duplicate key in bulk create")).cast("boolean")).otherwise(F.lit(True))
    return insert(target, rows.join(held, list(keys), "left").where(clash).select(*target.columns))


def bulk_update(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Sets the columns of ``rows`` on the target rows of the same keys; keys that are not there are left out."""
    values = {c: F.col(f"src_{c}") for c in rows.columns if c not in keys}
    return merge(target, rows, keys, update_set=values, insert_when=F.lit(False))


def derived(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Computed columns; later ones may use earlier ones."""
    for name, value in fields.items():
        df = df.withColumn(name, value)
    return df


def alive(df: DataFrame, deleted_at: str = "deleted_at") -> DataFrame:
    """Rows that no soft delete marks."""
    return df.where(F.col(deleted_at).isNull())


def as_of(history: DataFrame, at: Column, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Rows of a history table that were valid at a time; an open end is null."""
    return history.where((F.col(start) <= at) & (F.col(end).isNull() | (at < F.col(end))))


def as_of_join(left: DataFrame, right: DataFrame, by: Sequence[str], at: str, since: str, *ties: str) -> DataFrame:
    """Every left row beside the last right row of its key with ``since`` <= ``at``, or nulls. ``ties`` order right rows
    of one time. One sort of both tables by key and time; columns of ``right`` other than keys come as struct fields."""
    others = [c for c in right.columns if c not in by]
    events = right.select(*by, F.col(since).alias("__at"), F.lit(0).alias("__kind"), *[F.col(t).alias(f"__tie{k}") for k, t in enumerate(ties)], F.struct(*others).alias("__right"))
    asks = left.select(*by, F.col(at).alias("__at"), F.lit(1).alias("__kind"), F.struct(*left.columns).alias("__left"))
    both = events.unionByName(asks, allowMissingColumns=True)
    order = Window.partitionBy(*by).orderBy("__at", "__kind", *[f"__tie{k}" for k in range(len(ties))])
    found = both.withColumn("__right", F.last("__right", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return found.where("__kind = 1").select("__left.*", *[F.col("__right")[c].alias(c) for c in others])


def optimistic_update(target: DataFrame, source: DataFrame, keys: Sequence[str], version: str = "version") -> tuple[DataFrame, DataFrame]:
    """Applies rows whose version is the stored one, and counts it up; OUTPUT holds what was applied."""
    values = {c: F.col(f"src_{c}") for c in source.columns if c not in keys and c != version} | {version: F.col(version) + 1}
    return merge(target, source, keys, update_set=values, update_when=F.col(version) == F.col(f"src_{version}"), insert_when=F.lit(False))


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, broken): rows that break each table constraint, which Spark doesn't enforce."""
    counts = df.agg(*[F.count_if(~F.coalesce(c, F.lit(True))).alias(n) for n, c in rules.items()])
    return counts.unpivot([], list(rules), "rule", "broken")
