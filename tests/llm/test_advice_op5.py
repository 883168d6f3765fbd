"""Nearest neighbours where ids repeat: nothing found is lost behind copies of the query's own rows."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import crosspolytope

K = 5


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    x = rng.normal(size=8)
    near = [x + 0.01 * rng.normal(size=8) for _ in range(12)]
    other = [v + 0.01 * rng.normal(size=8) for v in [rng.normal(size=8)] * 14]
    out = [(100, x)] * 8  # a query stored eight times
    out += [(101 + n, v) for n, v in enumerate(near[:4])] + [(101, near[0])] * 2
    out += [(150, near[5])] * 2 + [(151 + n, near[5]) for n in range(9)] + [(152, near[5])]  # stored twice, with equal vectors of other ids
    out += [(200, v) for v in other[:13]] + [(201, other[13])]  # one id with many vectors
    out += [(250, rng.normal(size=8)) for _ in range(2)]
    return [(n, np.asarray(v, np.float32).tolist()) for n, v in out]


def test_repeated_ids(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = defaultdict(list)
    for r in crosspolytope.nearest(df, F.col("vec_id") % 50 == 0, K).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))

    def want(vector, query):
        q = np.array(vector)
        scored = [(-float(np.dot(v, q) / np.linalg.norm(v) / np.linalg.norm(q)), n) for n, v in ((n, np.array(v)) for n, v in rows) if n != query]
        return [n for _, n in sorted((round(s, 9), n) for s, n in scored)[:K]]

    for q in (100, 150):
        vector = next(v for n, v in rows if n == q)
        assert [n for _, n, _ in sorted(got[q])] == want(vector, q)
    assert len({tuple(v) for n, v in rows if n == 200}) == 13
    assert sum(n == 201 for _, n, _ in got[200]) == 13  # each vector of id 200 is a query row of its own
    assert all(n != q for q, found in got.items() for _, n, _ in found)


def test_crowded_cells_are_dealt_over_salts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=16)
    vectors = [centre + 0.02 * rng.normal(size=16) for _ in range(300)] + list(rng.normal(size=(300, 16)))
    df = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    layouts, layout = [], crosspolytope._layout
    monkeypatch.setattr(crosspolytope, "_layout", lambda classes: layouts.append(layout(classes)) or layouts[-1])

    def answers():
        return {(r.query_id, r["rank"], r.vec_id) for r in crosspolytope.nearest(df, F.col("vec_id") % 50 == 0, K).collect()}

    whole = answers()
    monkeypatch.setattr(crosspolytope, "CELL_ROWS", 25)
    assert answers() == whole and len(whole) == 12 * K
    assert not layouts[0].crowded and max(layouts[1].crowded.values()) >= 300 / 25


def test_overlong_vectors_are_refused(spark, monkeypatch):
    df = spark.createDataFrame([(n, [1.0, float(n)]) for n in range(3)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(crosspolytope, "LONGEST", 1)
    batch = next(iter(df.select("vec_id", F.col("embedding").alias("vector")).toArrow().to_batches()))
    with pytest.raises(ValueError, match="components"):
        list(crosspolytope._hash([batch]))


def test_among_best_counts_distinct_ids():
    scores, ids = np.array([0.9, 0.8, 0.7, 0.6, 0.5, 0.4]), np.array([7, 7, 7, 8, 9, 10])
    assert crosspolytope.among_best(scores, ids, 2).tolist() == [0, 1, 2, 3]
    assert crosspolytope.among_best(scores, ids, 4).tolist() == [0, 1, 2, 3, 4, 5]
    assert crosspolytope.among_best(scores, np.arange(6), 2).tolist() == [0, 1]
