"""Deduplication operators against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import lines, runindex, sigtree, superkmers
from tessera.llm.components import components


def key(i):
    return (i is not None, i or 0)


def test_matching_statistics_are_exact():
    rng = np.random.default_rng(3)
    for _ in range(25):
        strings = list({bytes(rng.choice([97, 98], rng.integers(1, 22)).astype(np.uint8)) for _ in range(rng.integers(1, 6))})
        got = runindex.RunLengthIndex(strings).matching_statistics()
        at = 0
        for a, s in enumerate(strings):
            for i in range(len(s)):
                best = 0
                for b, t in enumerate(strings):
                    for j in range(len(t)):
                        if (a, i) != (b, j):
                            k = 0
                            while i + k < len(s) and j + k < len(t) and s[i + k] == t[j + k]:
                                k += 1
                            best = max(best, k)
                assert got[at + i] == best
            at += len(s) + 1


def test_run_length_index(texts, docs, empty):
    got = {(r.doc_id, r.n_bytes): r for r in runindex.remove_repeated_bytes(docs).collect()}
    data = [(i, (t or "").encode()) for i, t, *_ in texts]
    count = Counter(x[k : k + 400] for _, x in data for k in range(len(x) - 399))
    for i, x in data:
        gone = np.zeros(len(x), bool)
        for k in range(len(x) - 399):
            if count[x[k : k + 400]] > 1:
                gone[k : k + 400] = True
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        r = got[i, len(x)]
        assert (r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) == (int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept), i
    assert runindex.remove_repeated_bytes(empty).count() == 0


def test_super_kmers(texts, docs, empty):
    got = {(r.doc_id, r.n_words): r for r in superkmers.remove_repeated_windows(docs).collect()}
    data = [(i, (t or "").encode().split()) for i, t, *_ in texts]
    first = {}
    for i, w in data:
        for k in range(len(w) - 12):
            at = tuple(w[k : k + 13])
            first[at] = min(first.get(at, (True, 1 << 60)), key(i))
    for i, w in data:
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < key(i):
                gone[k : k + 13] = [True] * 13
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        r = got[i, len(w)]
        assert (r.n_removed, r.kept_sha256, bytes(r.kept)) == (sum(gone), hashlib.sha256(kept).hexdigest(), kept), i
    assert superkmers.remove_repeated_windows(empty).count() == 0


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(superkmers.xxhash, "xxh3_64_intdigest", lambda w: len(w))
    a, b = [b"w%02d" % k for k in range(13)], [b"v%02d" % k for k in range(13)]
    gone = superkmers.removed_windows(a + b + a, np.array([1, 1, 1]), np.array([1, 2, 3]))
    assert gone.tolist() == [False, False, True]


@pytest.mark.parametrize("depth", [2, 3])
def test_line_runs(texts, docs, empty, depth):
    rows = lines.dedup_lines(docs, depth).collect()
    data = list(dict.fromkeys((i, t) for i, t, *_ in texts if t is not None))
    seqs = {(i, t): [x for x in t.split("\n") if x.split()] for i, t in data}
    first = {}
    for d in sorted(seqs, key=lambda d: key(d[0])):
        for k in range(len(seqs[d]) - depth + 1):
            first.setdefault(tuple(seqs[d][k : k + depth]), (d, k))
    expected = Counter()
    for i, t, *_ in texts:
        if t is None:
            expected[i, None] += 1
            continue
        s, gone = seqs[i, t], set()
        for k in range(len(s) - depth + 1):
            if first[tuple(s[k : k + depth])] != ((i, t), k):
                gone |= set(range(k, k + depth))
        kept, n = [], -1
        for x in t.split("\n"):
            if x.split():
                n += 1
                if n in gone:
                    continue
            kept.append(x)
        expected[i, "\n".join(kept)] += 1
    assert Counter((r.doc_id, r.text) for r in rows) == expected
    assert rows[0].block == "clash"
    assert lines.dedup_lines(empty).count() == 0


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_signature_trees(texts, docs, empty, k, percent):
    sets = []
    for i, t, *_ in texts:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[a : a + k]) for a in range(max(1, len(w) - k + 1))} if w else set()))
    parent = {key(i): key(i) for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            both = len(x & y)
            if both and 100 * both >= percent * len(x | y):
                p, q = find(key(i)), find(key(j))
                parent[max(p, q)] = min(p, q)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in sigtree.jaccard_groups(docs, k, percent).collect())
    real = lambda x: x[1] if x[0] else None
    assert got == Counter((i, len(s), real(find(key(i)))) for i, s in sets)
    assert sigtree.jaccard_groups(empty).count() == 0


def test_large_cells_are_dealt_over_pages(spark, docs, monkeypatch):
    want = {(r.doc_id, r.component_id) for r in sigtree.jaccard_groups(docs).collect()}
    monkeypatch.setattr(sigtree, "PAGE", 500)
    assert {(r.doc_id, r.component_id) for r in sigtree.jaccard_groups(docs).collect()} == want


def test_signature_tree_finds_every_group():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(90):
        base = rng.integers(0, 1 << 62, rng.integers(20, 200)).astype(np.uint64)
        for _ in range(rng.integers(1, 4)):
            own = base.copy()
            own[: rng.integers(0, 6)] = rng.integers(0, 1 << 62)
            sets.append(np.unique(own))
    groups = sigtree.Groups(len(sets))
    list(sigtree.SignatureTree(sets, 90).links(groups))
    brute = sigtree.Groups(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            if sigtree.linked(sets[i], sets[j], 90):
                brute.join(i, j)
    named = lambda g: [min(k for k in range(len(sets)) if g.find(k) == g.find(i)) for i in range(len(sets))]
    assert named(groups) == named(brute)


def test_components(spark):
    path = [(k, k + 1) for k in range(40)] + [(100, 101), (7, 7), (102, 101)]
    got = defaultdict(set)
    for r in components(spark.createDataFrame(path, "a long, b long")).collect():
        got[r.component].add(r.node)
    assert got == {0: set(range(41)), 100: {100, 101, 102}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_attach_beyond_the_broadcast_bound(spark, monkeypatch):
    from tessera.llm import common

    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    table = spark.createDataFrame([("a", 10), (None, 30)], "k string, w int")
    want = {("a", 1, 10), ("b", 2, None), (None, 3, 30)}
    assert {tuple(r) for r in common.attach(rows, table, ["k"]).collect()} == want
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    assert {tuple(r) for r in common.attach(rows, table, ["k"]).collect()} == want
