"""Line dedup of passages that stand on one line, against brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import lines


def maximal(copies):
    """Runs of (start, end, source) that copies of one source and shift make, without those inside others."""
    runs = set()
    for _, _, source in copies:
        own = sorted((a, b) for a, b, s in copies if s == source)
        while own:
            a, b = own.pop(0)
            while own and own[0][0] <= b:
                b = max(b, own.pop(0)[1])
            runs.add((a, b))
    return [r for r in runs if not any(o != r and o[0] <= r[0] and o[1] >= r[1] for o in runs)]


def brute(texts, min_lines, min_words):
    data = list(dict.fromkeys((i, t) for i, t, *_ in texts if t is not None))
    seqs = {d: [x for x in d[1].split("\n") if x.split()] for d in data}
    depths = [min_lines * 2**k for k in range(12)]
    first, one = {}, {}
    for d in sorted(seqs, key=lambda d: (d[0] is not None, d[0] or 0)):
        for k, x in enumerate(seqs[d]):
            one.setdefault(x, (d, k))
            for n in depths:
                if k + n <= len(seqs[d]):
                    first.setdefault(tuple(seqs[d][k : k + n]), (d, k))
    out = Counter()
    for i, t, *_ in texts:
        if t is None:
            out[i, None, 0, 0] += 1
            continue
        s, copies = seqs[i, t], []
        for k, x in enumerate(s):
            own = [n for n in depths if k + n <= len(s) and first[tuple(s[k : k + n])] != ((i, t), k)]
            if own:
                source, at = first[tuple(s[k : k + own[-1]])]
                copies.append((k, k + own[-1], (source, at - k)))
            if len(x.split()) > min_words and one[x] != ((i, t), k):
                copies.append((k, k + 1, (one[x][0], one[x][1] - k)))
        runs = maximal(copies)
        gone = {k for a, b in runs for k in range(a, b)}
        kept, n = [], -1
        for x in t.split("\n"):
            n += bool(x.split())
            if not (x.split() and n in gone):
                kept.append(x)
        out[i, "\n".join(kept), len(gone), len(runs)] += 1
    return out


def test_runs_that_only_touch_are_two(spark):
    rows = [(1, "A\nB"), (2, "B\nC"), (3, "A\nB\nC"), (4, "x\nA\nB\nC"), (5, "A\nA\nA\nA\nA"), (6, "C\nA\nB\nC\ny")]
    got = {r.doc_id: (r.text, r.lines_removed, r.runs_removed) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ("A\nB", 0, 0) and got[2] == ("B\nC", 0, 0)
    assert got[3] == ("", 3, 2)  # A, B of 1 and B, C of 2
    assert got[4] == ("x", 3, 2) and got[6] == ("C\ny", 3, 2)
    assert got[5] == ("A", 4, 1)
    assert {(i, *v) for i, v in got.items()} == set(brute(rows, 2, 10**9))


def test_deep_runs_are_followed_to_their_end(spark):
    passage = [f"line {k}" for k in range(37)]
    rows = [(1, "\n".join(["a", *passage])), (2, "\n".join(["b", *passage, "c"])), (3, "\n".join([*passage[5:20], "d", *passage[:3]]))]
    got = {r.doc_id: (r.text, r.lines_removed, r.runs_removed) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (rows[0][1], 0, 0), 2: ("b\nc", 37, 1), 3: ("d", 18, 2)}


@pytest.mark.parametrize(("depth", "words"), [(2, 50), (3, 20)])
def test_passages_on_one_line(texts, docs, empty, depth, words):
    rows = lines.dedup_lines(docs, depth, words).collect()
    assert Counter((r.doc_id, r.text, r.lines_removed, r.runs_removed) for r in rows) == brute(texts, depth, words)
    assert brute(texts, depth, words) != brute(texts, depth, 10**9)
    assert lines.dedup_lines(empty, depth, words).count() == 0


def test_pipeline_drops_passages_on_one_line(spark, tmp_path):
    long, short = " ".join(f"w{k}" for k in range(51)), " ".join(f"w{k}" for k in range(50))
    rows = [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd"), (3, f"e\n{short}\nf"), (4, f"g\n{short}\nh"), (5, long), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.char_length("text").cast("long"))
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.line_dedup(spark, df, "").collect()}
    want = dict(rows) | {2: "c\nd"}
    del want[5]
    assert got == {i: (t, t and len(t)) for i, t in want.items()}
