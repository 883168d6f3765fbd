"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target (its share of the words to take, by weight, at most ``CAP`` times its own
size) and a weight schedule over training time 0..1: straight lines between knots. A source's demand
up to time ``t`` is the integral of its schedule, scaled to its target; a document that starts after
``c`` taken words of its source gets the time at which that demand reaches ``c``. Sorting by time
gives the training order; within a source, documents come in the order of a hash of their id, a
second epoch after the first.

All of it is DataFrame code. Prefix sums over a source go in two levels: sums per (source, bucket of
the hash), running sums over the at most ``BUCKETS`` buckets of a source, then running sums within
a bucket, so that no task gets a whole source.

Defined results: a null text has size 0; the null source comes last; repeated rows are documents of
their own (ties in the hash are broken by id, size and text); an empty table gives an empty mix; sources
without words have target 0. Extra columns are kept aside.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, stage, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
BUCKETS = 2048
#: Schedules by rank of weight, as (time, relative weight) knots: the heaviest sources fade, the lightest grow.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per source (source, source_size) -> with ``rank``, ``weight`` and ``target``.

    Water filling in closed form: sources in the order of cap over weight; the first k stop at
    their caps, the rest share what is left by weight, for the first k at which that fits.
    """
    by_code = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.pmod(F.row_number().over(by_code) - 1, F.lit(len(weights))))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("rank") + 1)).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    filled = (
        ranked.withColumn("want", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("capped_before", F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("weight_left", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("want") - F.coalesce("capped_before", F.lit(0.0))) / F.col("weight_left"))
        # along the order the level rises until it fits under the next cap, then falls
        .withColumn("fits", F.max("level").over(everything))
    )
    return filled.select("source", "source_size", F.col("rank").cast("int").alias("rank"), "weight", F.least(F.col("most"), F.col("fits") * F.col("weight")).alias("target"))


def invert_schedule(done: Column, rank: Column, schedules: tuple = SCHEDULES) -> Column:
    """Time in 0..1 at which a schedule's integral is the share ``done`` of the whole."""

    def one(knots: tuple) -> Column:
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
        total, before, out = sum(areas), 0.0, F.lit(knots[-1][0])
        parts = []
        for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas):
            slope, rest = (w1 - w0) / (t1 - t0), F.greatest(done * total - before, F.lit(0.0))
            # area under a line: w0 x + slope x^2 / 2 = rest, in the form that also holds for slope 0
            x = F.lit(2.0) * rest / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0))))
            before += area
            parts.append((before / total, F.lit(t0) + F.least(x, F.lit(t1 - t0))))
        for upto, value in reversed(parts):
            out = F.when(done <= upto, value).otherwise(out)
        return out

    choice = F.when(rank == 0, one(schedules[0]))
    choice = reduce(lambda c, k: c.when(rank == k, one(schedules[k])), range(1, len(schedules)), choice)
    return choice.otherwise(F.lit(1.0))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, schedules: tuple = SCHEDULES, key: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, position, position2.

    ``position`` is the document's training time in the first epoch, ``position2`` in the second
    (null where the mix doesn't take it then). ``key``: a column of ``docs`` that tells its rows apart, returned as ``key``.
    """
    row = F.lit(None).cast("long") if key is None else F.col(key).cast("long")
    sized = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("copy"), row.alias("key"))
    sized = sized.withColumn("order", F.xxhash64("doc_id")).withColumn("bucket", F.pmod(F.shiftrightunsigned("order", 20), F.lit(BUCKETS)))
    sized = stage(sized, "mix-sizes")
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    steps = Window.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("before", F.sum("bucket_size").over(steps.rowsBetween(Window.unboundedPreceding, -1))).withColumn("before", F.coalesce("before", F.lit(0)))
    sums = stage(sums, "mix-buckets")
    targets = stage(source_targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, share, cap), "mix-targets")
    plan = stage(attach(sums.drop("bucket_size"), targets, ["source"]), "mix-plan")

    within = Window.partitionBy("source", "bucket").orderBy("order", "doc_id", "size", "copy", "key")
    placed = sized.withColumn("offset", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    placed = attach(placed, plan, ["source", "bucket"]).withColumn("offset", F.col("offset") + F.col("before"))
    goal = F.round("target").cast("long")

    def part(start: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), goal - start)).cast("long")

    def at(start: Column) -> Column:
        return F.when((start < goal) & (F.col("size") > 0), invert_schedule(start / F.greatest(goal, F.lit(1)), F.col("rank"), schedules))

    again = F.col("offset") + F.col("source_size")
    out = ["doc_id", "source", "size", "source_size", "target"] + ["key"] * (key is not None)
    return placed.select(*out, (part(F.col("offset")) + part(again)).alias("taken"), at(F.col("offset")).alias("position"), at(again).alias("position2"))


def curriculum(docs: DataFrame, **parameters) -> DataFrame:
    """The training order: a row per taken document and epoch, range-sorted by position; ``taken`` are the words
    taken in that epoch."""
    m = mix(docs, **parameters)
    whole = F.least("taken", "size")  # the second epoch takes what the first leaves
    epochs = F.array(
        F.struct(F.lit(1).alias("epoch"), whole.alias("words"), F.col("position").alias("at")),
        F.struct(F.lit(2).alias("epoch"), (F.col("taken") - whole).alias("words"), F.col("position2").alias("at")),
    )
    kept = ["doc_id", "source", "size", "source_size", "target"]
    # staged, so that the sort's sampling doesn't repeat the mix
    rows = stage(m.select(*kept, F.explode(epochs).alias("e")).select(*kept, F.col("e.words").alias("taken"), "e.epoch", F.col("e.at").alias("position")).where("position is not null"), "mix-order")
    return rows.orderBy("position", "doc_id", "epoch")


def training_order(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``mix``, one per document with both its epochs' words in ``taken``, range-sorted by the position at which
    training first meets it; documents that the mix doesn't take come last."""
    # staged, so that the sort's sampling doesn't repeat the mix
    return stage(mix(docs, **parameters), "mix-order").orderBy(F.col("position").asc_nulls_last(), "doc_id")
