"""Line deduplication over a suffix array of line-id sequences.

Each document is a sequence of line ids (128-bit hashes of the lines; lines without a word are no
part of it). Prefix doubling ranks every suffix by its first 1, 2, 4, ... lines: the rank at depth
2k is that of the pair (rank at depth k here, rank at depth k, k lines on). Ranks are the true
lexicographic ones: the distinct pairs are counted map-side, range-sorted, and numbered by running
sums per partition plus the partitions' offsets, so no task sorts a large group of
copies. Suffixes whose rank is unique are set aside, as nothing repeats from there, and doubling goes on
until none is left: as far as the longest run that repeats.

Suffixes of equal rank at a depth are an interval of the suffix array whose longest common prefixes reach that depth.
Its first occurrence (smallest doc_id, then position) names it and stays. A later suffix belongs to its deepest
interval: its lines of that depth are a copy of the interval's first. Copies whose first ones lie in one document at one
distance continue each other and make one run, so that every run that is deleted stands elsewhere as a whole; runs inside others
don't count. The first depth is ``MIN_LINES``, the least length of a run.

A passage may be written as one line, which is no run of ``MIN_LINES``. With ``min_words``, later
copies of a line of more words than that go too, whatever stands beside them: such lines have their
rank from depth 1. Without it, runs are measured in lines alone, as in the SQL of ``op8_line_runs``.

Defined results: a null text has no lines and stays null; lines are split at "\\n"; lines without a
word stay where they are; rows of one doc_id with different texts are documents of their own,
and repeats of a whole row share one fate: all are judged as that document; an empty table gives an
empty table; extra columns are kept (lines_removed and runs_removed
are replaced).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, settle, small_batches, stage

MIN_LINES = 2
#: A line of more words than this is a passage: the pipeline counts a copy of it as a run.
PASSAGE_WORDS = 50
PLACE = ["doc_id", "copy", "pos"]


def line_sequences(docs: DataFrame, min_words: int | None = None) -> DataFrame:
    """(doc_id, copy, pos, line): lines with a word, numbered within the document; ``copy`` tells
    documents of one doc_id apart. With ``min_words`` also ``long``: whether the line has more words."""
    lines = F.filter(F.split(F.col("text"), "\n", -1), lambda x: F.regexp_count(x, F.lit(WORD)) > 0)
    hashed = lambda x: F.unhex(F.md5(x.cast("binary")))
    place = [F.col("doc_id").cast("long"), F.xxhash64("text").alias("copy")]
    docs = docs.where(F.col("text").isNotNull())
    if min_words is None:
        return docs.select(*place, F.posexplode(F.transform(lines, hashed)).alias("pos", "line"))
    marked = F.transform(lines, lambda x: F.struct(hashed(x).alias("line"), (F.regexp_count(x, F.lit(WORD)) > min_words).alias("long")))
    return docs.select(*place, F.posexplode(marked).alias("pos", "l")).select(*PLACE, "l.line", "l.long")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0
    for b in batches:
        n = b.column("n").to_numpy()
        sums = np.cumsum(n) + total
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sums - n)], [*b.schema.names, "before"])
        total = int(sums[-1]) if len(sums) else total


def ranked(rows: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """Adds ``rank``: 1 + the number of rows with smaller keys; ``rank_n``: rows with equal keys; ``first``: their first place."""
    pairs = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.struct(*PLACE)).alias("first"))
    ordered = pairs.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id().cast("long"))
    fields = ", ".join(f"{k} {t}" for k, t in ordered.dtypes)
    numbered = stage(ordered.mapInArrow(_running, f"{fields}, before long"), "ranks")
    # One row per partition of the sort: their number doesn't grow with the rows of a partition.
    parts = numbered.groupBy("part").agg(F.sum("n").alias("total"))
    offsets = parts.select("part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    shared = numbered.where("n > 1").join(offsets, "part").select(*keys, F.col("n").alias("rank_n"), (F.col("offset") + F.col("before") + 1).alias(rank), "first")
    return rows.join(shared, keys)


def line_ranks(lines: DataFrame) -> DataFrame:
    """``lines``, (doc_id, copy, pos, line), with ``rank`` and ``first`` in place of ``line``: the rank of each suffix by its
    first line, where it is shared, and the place where that line stands first."""
    return stage(ranked(lines, ["line"], "rank").drop("line", "rank_n"), "ranks1")


def deeper_ranks(known: DataFrame, step: int) -> DataFrame:
    """Ranks of the suffixes that are ``step`` lines deeper than ``known`` and shared there; the others drop out."""
    known = known.select(*PLACE, "rank")
    later = known.select(F.col("doc_id").alias("d"), F.col("copy").alias("c"), (F.col("pos") - step).alias("p"), F.col("rank").alias("next"))
    pairs = stage(known.join(later, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c")) & (F.col("pos") == F.col("p"))).drop("d", "c", "p"), "suffix-pairs")
    return stage(ranked(pairs, ["rank", "next"], "deeper").select(*PLACE, F.col("deeper").alias("rank"), "first"), "ranks")


def later_copies(known: DataFrame, depth: int) -> DataFrame:
    """The suffixes whose rank at a depth stands earlier too, with the first place of it."""
    later = known.where(~F.struct(*PLACE).eqNullSafe(F.col("first")))
    return later.select(*PLACE, F.lit(depth).alias("depth"), "first")


def suffix_copies(known: DataFrame, min_lines: int) -> DataFrame:
    """(doc_id, copy, pos, depth, first): every later suffix with the deepest interval in which it is one; ``known`` holds
    the ranks of depth 1."""
    depth, found = 1, [later_copies(known, 1)] if min_lines == 1 else []
    while depth < min_lines or not known.isEmpty():
        step = min(depth, min_lines - depth) if depth < min_lines else depth  # the last round before min_lines may overlap
        known = deeper_ranks(known, step)
        depth += step
        if depth >= min_lines:
            found.append(later_copies(known, depth))
    copies = found[0]
    for more in found[1:]:
        copies = copies.unionByName(more)
    return copies.groupBy(*PLACE).agg(F.max(F.struct("depth", "first")).alias("deepest")).select(*PLACE, "deepest.depth", "deepest.first")


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """(doc_id, copy, copies): of each document the later copies among its lines with a word: where they start, how many
    lines they have, and which lines of which document they repeat. With ``min_words`` also lines of more words (copies of one line)."""
    known = line_ranks(line_sequences(docs, min_words))
    later = suffix_copies(known, min_lines)
    if min_words is not None:
        later = later.unionByName(later_copies(known.where("long"), 1))
    one = F.struct("pos", "depth", F.xxhash64("first.doc_id", "first.copy").alias("source"), (F.col("first.pos") - F.col("pos")).alias("shift"))
    return later.groupBy("doc_id", "copy").agg(F.collect_list(one).alias("copies"))  # bounded by the document's lines


def runs_of(copies: Iterable[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Maximal runs (start, end) of copies (pos, depth, source, shift): those of one source and shift continue each other."""
    spans: dict[tuple[int, int], list[list[int]]] = {}
    for pos, depth, source, shift in sorted(copies):
        own = spans.setdefault((source, shift), [])
        if own and pos <= own[-1][1]:
            own[-1][1] = max(own[-1][1], pos + depth)
        else:
            own.append([pos, pos + depth])
    out: list[tuple[int, int]] = []
    for start, end in sorted((tuple(x) for own in spans.values() for x in own), key=lambda x: (x[0], -x[1])):
        if not out or end > out[-1][1]:
            out.append((start, end))
    return out


def without_runs(text: bytes, copies: Iterable[tuple[int, int, int, int]]) -> tuple[bytes, int, int]:
    """The text without the lines of its repeated runs; the lines and the maximal runs that went."""
    runs = runs_of(copies)
    gone = {line for start, end in runs for line in range(start, end)}
    kept, k = [], -1
    for line in text.split(b"\n"):
        if line and not line.isspace():
            k += 1
            if k in gone:
                continue
        kept.append(line)
    return b"\n".join(kept), len(gone), len(runs)


def _remove(copies: str):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lines, runs = [], [], []
            for text, own in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column(copies).to_pylist()):
                new = without_runs(text, [tuple(c.values()) for c in own]) if text is not None and own else (text, 0, 0)
                texts.append(new[0])
                lines.append(new[1])
                runs.append(new[2])
            keep = [n for n in b.schema.names if n not in ("text", copies)]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in keep], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(runs, pa.int64())], [*keep, "text", "lines_removed", "runs_removed"])

    return remove


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """The documents with later copies of repeated line runs removed from their text, and how many
    lines and runs went (lines_removed, runs_removed). Runs have ``min_lines`` lines, or with ``min_words``
    one line of more words than that."""
    small_batches(docs.sparkSession)
    docs = docs.drop("lines_removed", "runs_removed").withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    own = {n: fresh(docs, n) for n in ("doc", "copy", "copies")}
    found = settle(docs.sparkSession, lambda: repeated_lines(docs, min_lines, min_words), "line-runs").withColumnRenamed("doc_id", "doc").withColumnsRenamed(own)
    # the same plan at every size: texts are dealt once, never held against a broadcast
    joined = docs.join(found.hint("merge"), docs["doc_id"].eqNullSafe(found[own["doc"]]) & (F.xxhash64(docs["text"]) == found[own["copy"]]), "left")
    joined = joined.select(*[docs[c] for c in docs.columns], found[own["copies"]])
    schema = ", ".join([f"`{n}` {t}" for n, t in docs.dtypes if n != "text"] + ["text string", "lines_removed long", "runs_removed long"])
    return joined.mapInArrow(_remove(own["copies"]), schema)
