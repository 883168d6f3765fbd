"""Approximate nearest neighbours by cross-polytope hashing.

A hash turns a unit vector by a pseudo-rotation (three rounds of random signs and the fast Hadamard
transform) and takes the nearest signed axis. A table joins two such hashes; its cells are groups of
neighbouring axes of the first, and within a cell rows carry both. A query probes, per table, the
``PROBES`` pairs of axes it is nearest to, and travels once to each cell that holds some of them. In
each cell the candidates are scored exactly (cosine, double precision) and the best go on; a query's
best over all cells are its answer.

Equal vectors are one class, with its few smallest distinct ids and how often each is stored: a vector
that fills a third of the table is hashed and scored once. Wherever only the best go on, distinct ids
are counted, as all rows of one id may turn out to be the query's own. The random signs come from a
seed; nothing is fitted. A cell that holds more than ``CELL_ROWS`` classes, as near copies of one vector
may, is dealt over salts by its own count, and only its queries travel to each of them.

Defined results: vectors that are null, zero or hold null or non-finite components take no part, as
queries or candidates; vectors of different lengths don't match,
and those of over ``LONGEST`` components raise an error; ties go to the smaller id; repeated
ids are separate rows (a row is no candidate of queries of its own id; query rows of one id with
different vectors are answered each, equal ones once); with fewer candidates than
``k`` all of those found come back; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_key, record_batch, shuffle_width, stage

TABLES = 12
PROBES = 400
AXES = 32  # of each hash, among which the probed pairs are sought
SEED = 20240501
#: A cell takes this many bits' worth of neighbouring axes, at any size of the table, so that a query's cells are as many.
FOLD = 2
#: Index rows of a cell, beyond which it is dealt over salts.
CELL_ROWS = 16_000
#: Components of a vector: an axis takes 16 bits.
LONGEST = 1 << 15
CLASSES = "class long, first long, vector array<{kind}>, members array<struct<vec_id:long,copies:int>>, codes array<int>"
CELLS = "cell long, kind int, class long, first long, codes binary, vector binary"
FOUND = "query long, class long, first long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def axis_scores(unit: np.ndarray, table: int, part: int) -> np.ndarray:
    """Projections on the signed axes (all positive ones, then all negative ones) of one hash."""
    dim = unit.shape[1]
    wide = 1 << max(1, (dim - 1).bit_length())
    x = np.zeros((len(unit), wide))
    x[:, :dim] = unit
    signs = np.random.default_rng([SEED, table, part]).choice([-1.0, 1.0], (3, wide))
    for s in signs:
        x = hadamard(x * s)
    return np.concatenate([x, -x], 1)


def _groups(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors), once for each length of vectors."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        yield own, vectors.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).reshape(len(own), n)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``codes``: the pair of axes of each table, the first one in the upper 16 of 32 bits."""
    for batch in batches:
        codes = np.zeros((len(batch), TABLES), np.uint32)
        for own, vectors in _groups(batch.column("vector")):
            if vectors.shape[1] > LONGEST:
                raise ValueError(f"vectors may have {LONGEST} components at most")
            unit = _unit(vectors)
            for t in range(TABLES):
                codes[own, t] = axis_scores(unit, t, 0).argmax(1) << 16 | axis_scores(unit, t, 1).argmax(1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * TABLES, pa.int32()), pa.array(codes.reshape(-1).view(np.int32)))
        yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "codes"])


class Cells:
    """Numbers cells: by length of vectors, table and group of ``2**FOLD`` axes of the first hash. ``crowded`` has
    the salts of the cells that have several."""

    def __init__(self, crowded: dict[int, int]):
        self.crowded = crowded

    def number(self, dim: int, table: int, axis):
        return ((dim * TABLES + table) << 16) + (axis >> FOLD)

    def column(self) -> Column:
        """The same number, of the table ``t`` and the pair ``code`` of a row."""
        return F.shiftleft(F.size("vector").cast("long") * TABLES + F.col("t"), 16) + F.shiftrightunsigned("code", 16 + FOLD)

    def salts(self, cell: int) -> int:
        return self.crowded.get(cell, 1)


SALTED = 1 << 20  # salts of a cell, at most, in the numbers that rows are dealt by


def _index(cells: Cells, kind: str):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, firsts = (batch.column(n).to_numpy() for n in ("class", "first"))
            codes = batch.column("codes").flatten().to_numpy().view(np.uint32).reshape(len(batch), TABLES)
            for own, vectors in _groups(batch.column("vector")):
                raw = [v.tobytes() for v in vectors.astype(kind)]
                for t in range(TABLES):
                    code = codes[own, t]
                    rows = []
                    for i, f, v, cell, c in zip(classes[own].tolist(), firsts[own].tolist(), raw, cells.number(vectors.shape[1], t, code.astype(np.int64) >> 16).tolist(), code.tolist()):
                        rows.append((cell * SALTED + i % cells.salts(cell), 0, i, f, c.to_bytes(4, "little"), v))
                    yield record_batch(rows, CELLS)

    return index


def best_pairs(first: np.ndarray, second: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the pairs of axes with the largest sums of projections."""
    m = min(AXES, first.shape[1])
    a, b = np.argsort(-first, 1)[:, :m], np.argsort(-second, 1)[:, :m]
    total = np.take_along_axis(first, a, 1)[:, :, None] + np.take_along_axis(second, b, 1)[:, None]
    best = np.argsort(-total.reshape(len(first), -1), 1)[:, :probes]
    return np.take_along_axis(a, best // m, 1), np.take_along_axis(b, best % m, 1)


def _probe(cells: Cells, kind: str):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, firsts = (batch.column(n).to_numpy() for n in ("class", "first"))
            for own, vectors in _groups(batch.column("vector")):
                unit = _unit(vectors)
                raw = [v.tobytes() for v in vectors.astype(kind)]
                for t in range(TABLES):
                    first, second = best_pairs(axis_scores(unit, t, 0), axis_scores(unit, t, 1), PROBES)
                    pairs, groups = (first << 16 | second).astype("<u4"), cells.number(vectors.shape[1], t, first)
                    rows = []
                    for i, f, v, pair, group in zip(classes[own].tolist(), firsts[own].tolist(), raw, pairs, groups):
                        for cell in np.unique(group).tolist():
                            codes = pair[group == cell].tobytes()
                            rows += [(cell * SALTED + s, 1, i, f, codes, v) for s in range(cells.salts(cell))]
                    yield record_batch(rows, CELLS)

    return probe


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return (vectors * query).sum(1) / (np.sqrt((vectors * vectors).sum(1)) * math.sqrt(float((query * query).sum())))


def among_best(scores: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Places of the scores down to the best one of the ``keep``-th distinct id; ties there all stay."""
    if len(scores) <= keep:
        return np.arange(len(scores))
    good = np.flatnonzero(scores >= np.partition(scores, -keep)[-keep])
    if len(np.unique(ids[good])) >= keep:
        return good
    order = np.argsort(-scores, kind="stable")
    leads = np.sort(np.unique(ids[order], return_index=True)[1])
    return np.flatnonzero(scores >= scores[order[leads[keep - 1]]]) if len(leads) > keep else np.arange(len(scores))


def _score(kind: str, keep: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_key(batches, "cell"):
            index = [r for r in rows if r["kind"] == 0]
            queries = [r for r in rows if r["kind"] == 1]
            if not index or not queries:
                continue
            vectors = np.frombuffer(b"".join(r["vector"] for r in index), kind).astype(np.float64).reshape(len(index), -1)
            ids, firsts = (np.array([r[n] for r in index], np.int64) for n in ("class", "first"))
            # the pairs that the cell's rows have, and where the rows of each of them stand
            pairs, places = np.unique(np.frombuffer(b"".join(r["codes"] for r in index), "<u4"), return_inverse=True)
            out = []
            for q in queries:
                wanted = np.isin(pairs, np.frombuffer(q["codes"], "<u4"))
                at = np.flatnonzero(wanted[places])
                if len(at):
                    s = cosines(np.frombuffer(q["vector"], kind).astype(np.float64), vectors[at])
                    # ties at the last place all stay: their ids decide later
                    good = among_best(s, firsts[at], keep)
                    out += zip([q["class"]] * len(good), ids[at[good]].tolist(), firsts[at[good]].tolist(), s[good].tolist())
            if out:
                yield record_batch(out, FOUND)

    return score


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def leading(rows: DataFrame, name: str, n: int) -> DataFrame:
    """All rows of the ``n`` distinct values of ``name`` that have a query's best scores; ties go to the smaller."""
    lead = rows.withColumn("lead", F.max("score").over(Window.partitionBy("query", name)))
    return lead.withColumn("r", F.dense_rank().over(Window.partitionBy("query").orderBy(F.desc("lead"), name))).where(F.col("r") <= n).drop("lead", "r")


def _layout(classes: DataFrame) -> Cells:
    """Finds the crowded cells: no more than there are tables, groups of axes and lengths of vectors."""
    held = classes.select("vector", F.posexplode("codes").alias("t", "code")).groupBy(Cells({}).column().alias("cell")).count()
    return Cells({r["cell"]: min(SALTED, math.ceil(r["count"] / CELL_ROWS)) for r in held.where(F.col("count") > CELL_ROWS).collect()})


def nearest(rows: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): up to ``k`` nearest rows of each query row; ``rows`` has
    vec_id and embedding."""
    spark = rows.sparkSession
    kind = "<f4" if dict(rows.dtypes)["embedding"] == "array<float>" else "<f8"
    fine = rows.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long"), F.col("embedding").alias("vector"), is_query.alias("asks")).where("vec_id is not null")
    # the smallest ids of each class of equal vectors: limited before the shuffle
    stored = fine.groupBy("vector", "vec_id").agg(F.count("*").alias("copies"))
    smallest = stored.withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    member = F.struct("vec_id", F.least("copies", F.lit(k)).cast("int").alias("copies"))
    classes = smallest.groupBy("vector").agg(F.min("vec_id").alias("first"), F.array_sort(F.collect_list(member)).alias("members"))
    # an id may have several vectors, so that its classes need numbers of their own: fixed once they are written
    numbered = classes.select(F.monotonically_increasing_id().alias("class"), "first", "vector", "members")
    classes = stage(numbered.mapInArrow(_hash, CLASSES.format(kind="float" if kind == "<f4" else "double")), "vector-classes")
    asked = fine.where("asks").select("vector").distinct().join(classes.select("vector", "class", "first"), "vector")
    cells = _layout(classes)
    index = classes.select("class", "first", "vector", "codes").repartition(shuffle_width(spark), "class").mapInArrow(_index(cells, kind), CELLS)
    probes = asked.select("class", "first", "vector").repartition(shuffle_width(spark), "class").mapInArrow(_probe(cells, kind), CELLS)
    found = index.unionByName(probes).repartition(4 * shuffle_width(spark), "cell").sortWithinPartitions("cell").mapInArrow(_score(kind, k + 1), FOUND)
    # a class found in several tables has one score
    top = leading(found.groupBy("query", "class", "first").agg(F.max("score").alias("score")), "first", k + 1)
    members = top.join(classes.select("class", F.explode("members").alias("m")), "class").select("query", "m.vec_id", "m.copies", "score")
    answers = stage(leading(members, "vec_id", k + 1), "class-answers")
    queries = fine.where("asks").join(classes.select("vector", F.col("class").alias("query")), "vector").select(F.col("vec_id").alias("query_id"), "query")
    own = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    others = queries.distinct().join(answers, "query").where("query_id != vec_id")
    each = others.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    result = each.withColumn("rank", F.row_number().over(own).cast("int")).where(F.col("rank") <= k)
    return result.select("query_id", "rank", "vec_id", "score")
