"""Collapse of cumulative conversation snapshots, and rendering.

Loggers often store a conversation after every turn, so that most logs are prefixes of a longer
one. Each conversation gets rolling hashes of its turn prefixes: running sums, in two lanes, of
hashes of (ordinal, role, text). A conversation goes if its whole hash is the hash of a proper
prefix of another (anti-join); of equal conversations the one with the smallest id stays. The
maximal ones are rendered in a chat template.

Running sums go in two levels (within blocks of turns, then over the blocks of a conversation), and
rendering makes one row per ``PART`` turns: a conversation with a third of all turns doesn't meet in
one task. Prefixes are deduplicated before they are compared, so a common first turn is one row.

Defined results: turns are ordered by turn number (null first), role, text; exact repeats of a row
count once; null roles and texts count as empty; a null conv_id is a conversation like others; an
empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, stage

BLOCK = 64  # turn numbers in a block
PART = 64  # turns in a rendered row
#: Chat template; fixed values of the common chat markup.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv, ordinal, role, text): distinct turns numbered from 1 in each conversation."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK))
    inside = Window.partitionBy("conv", "block").orderBy("turn", "role", "text")
    rows = stage(rows.withColumn("inner", F.row_number().over(inside)), "turns")
    return _with_offsets(rows, [F.count("*").alias("step")], "before0").withColumn("ordinal", (F.col("inner") + F.col("before0")).cast("long")).drop("inner", "before0", "turn")


def _with_offsets(rows: DataFrame, sums: list[Column], *names: str) -> DataFrame:
    """Adds running sums over the earlier blocks of the same conversation."""
    blocks = rows.groupBy("conv", "block").agg(*sums)
    steps = [c for c in blocks.columns if c not in ("conv", "block")]
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(F.col("conv").alias("c"), F.col("block").alias("b"), *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(n) for s, n in zip(steps, names)])
    return rows.join(offsets, rows["conv"].eqNullSafe(offsets["c"]) & rows["block"].eqNullSafe(offsets["b"])).drop("c", "b")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv, ordinal, h1, h2) of every turn prefix; ``turns`` as from ``numbered_turns``."""
    lane = lambda seed: F.shiftrightunsigned(F.xxhash64(F.lit(seed), "ordinal", "role", "text"), 24)  # noqa: E731  40 bits: sums of 2^23 turns fit
    rows = turns.select("conv", "block", "ordinal", lane(1).alias("a1"), lane(2).alias("a2"))
    rows = _with_offsets(rows, [F.sum("a1").alias("s1"), F.sum("a2").alias("s2")], "before1", "before2")
    inside = Window.partitionBy("conv", "block").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select("conv", "ordinal", (F.sum("a1").over(inside) + F.col("before1")).alias("h1"), (F.sum("a2").over(inside) + F.col("before2")).alias("h2"))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv, turns): conversations that prefix no longer one, one of each group of equals."""
    hashes = stage(prefix_hashes(turns), "prefixes")
    lengths = hashes.groupBy(F.col("conv").alias("c")).agg(F.max("ordinal").alias("turns"))
    whole = hashes.join(lengths, hashes["conv"].eqNullSafe(lengths["c"])).drop("c")
    key = ["ordinal", "h1", "h2"]
    # min would skip a null id
    complete = whole.where("ordinal = turns").groupBy(*key).agg(F.min(F.struct("conv")).alias("conv"))
    proper = whole.where("ordinal < turns").select(*key).distinct()
    return complete.join(proper, key, "left_anti").select("conv.conv", F.col("ordinal").alias("turns"))


def collapse_and_render(turns: DataFrame) -> DataFrame:
    """(conv_id, part, turns, text): maximal conversations in the chat template, ``PART`` turns a row."""
    spark = turns.sparkSession
    rows = settle(spark, lambda: numbered_turns(turns), "ordered-turns")
    kept = settle(spark, lambda: maximal(rows), "maximal").withColumnRenamed("conv", "c")
    rows = rows.join(kept, rows["conv"].eqNullSafe(kept["c"]))
    said = F.concat(F.lit(OPEN), F.col("role"), F.lit("\n"), F.col("text"), F.lit(CLOSE)).alias("said")
    parts = rows.select("conv", "ordinal", "turns", F.floor((F.col("ordinal") - 1) / PART).cast("long").alias("part"), said).groupBy("conv", "part", "turns").agg(F.array_sort(F.collect_list(F.struct("ordinal", "said"))).alias("all"))
    return parts.select(F.col("conv").alias("conv_id"), "part", "turns", F.array_join(F.col("all")["said"], "").alias("text"))
