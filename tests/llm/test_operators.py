"""The other operators: brute force, round trips and edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, crosspolytope, mixing, packing, quality, warc

WORD = re.compile("[^\x20\x09-\x0d]+")


def test_chat_collapse(spark):
    rows = []

    def say(conv, *turns):
        rows.extend((conv, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(turns))

    say(1, "hi", "hello")
    say(2, "hi", "hello", "more")
    say(3, "hi", "hello", "other")
    say(4, "hi", "hello", "more")  # equal to 2
    say(5, "bye")
    say(6, *[f"t{k}" for k in range(150)])
    say(7, *[f"t{k}" for k in range(149)])
    say(None, "null id", None)
    rows += [(8, 0, None, "x"), (8, 0, None, "x"), (8, 0, "user", "y"), (9, None, "user", "no turn")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, block string")
    got = chat.collapse_and_render(df).collect()
    assert {r.conv_id for r in got} == {2, 3, 5, 6, 8, 9, None}
    whole = defaultdict(str)
    for r in sorted(got, key=lambda r: r.part):
        whole[r.conv_id] += r.text
    assert whole[5] == "<|im_start|>user\nbye<|im_end|>\n"
    assert whole[6].count("<|im_start|>") == 150 and {r.turns for r in got if r.conv_id == 8} == {2}
    assert whole[6].index("t63<") < whole[6].index("t64<")
    assert chat.collapse_and_render(df.where("false")).count() == 0


def test_chunk_framing_and_segments():
    rng = random.Random(1)
    for n in (0, 1, 4096, 4097, 70_000):
        payload = rng.randbytes(n)
        assert warc.unframe(warc.frame(payload)) == payload
        records = warc.page_records("7.0.1", 7, "http://x/ y", payload, warc.hashlib.sha1(payload).hexdigest(), None)
        archive = b"".join(warc.member(r) + b"\0" for r in records)
        assert warc.zlib.decompress(warc.member(records[0]) + b"\0", 31) == records[0] + b"\r\n\r\n"
        parsed = list(warc.parse_records(warc.inflate(archive, 1000)))
        assert parsed == list(warc.parse_records(warc.inflate(b"".join(r + b"\r\n\r\n" for r in records), 700)))
        with pytest.raises(ValueError):
            list(warc.parse_records(warc.inflate(archive[:-3])))
        assert len(parsed) == len(records) == max(1, -(-sum(len(b) for _, b in parsed) // warc.SEGMENT))
    with pytest.raises(ValueError):
        warc.unframe(b"5\r\nabc\r\n0\r\n\r\n")


def test_warc_round_trip(spark):
    big, middle = "é" * 40_000 + "WARC/1.1\r\n\r\n", "m" * 1200
    rows = [(1, "u", "small"), (2, "u", "small"), (3, None, big), (4, "u", big), (5, "u", big), (6, "u", None), (7, "a b", middle), (7, "a b", middle), (8, "u", ""), (None, "u", "z")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    got = sorted((r.page_id or 0, r.payload_bytes, r.kind, r.refers_to) for r in warc.round_trip(pages).collect())
    size = len(big.encode())
    assert got == sorted([(1, 5, "response", None), (2, 5, "response", None), (3, size, "revisit", 5), (4, size, "revisit", 5), (5, size, "response", None), (6, 0, "response", None), (7, 1200, "response", None), (7, 1200, "response", None), (8, 0, "response", None), (0, 1, "response", None)])
    assert warc.round_trip(pages.where("false")).count() == 0


def test_a_page_beyond_any_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 100)
    huge = random.Random(5).randbytes(10 << 20).hex()
    pages = spark.createDataFrame([(1, "u", huge), (2, "u", "small")], "page_id long, url string, html string").coalesce(1)
    warc.write_warc(pages, str(tmp_path / "a"))
    files = list((tmp_path / "a").glob("part-*"))
    assert len(files) > 3 and max(f.stat().st_size for f in files) < 100 * (warc.SEGMENT + 1000)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.intact) for r in warc.read_warc(spark, str(tmp_path / "a"), keep_payload=False).collect()}
    assert got[1] == (len(huge), warc.hashlib.sha1(huge.encode()).hexdigest(), True) and got[2][0] == 5


def test_damaged_segments(spark, tmp_path):
    payload = random.Random(2).randbytes(100_000)
    records = warc.page_records("1.0.1", 1, "u", payload, warc.hashlib.sha1(payload).hexdigest(), None)
    import gzip

    for name, chosen in (("whole", records[::-1]), ("missing", records[:1] + records[2:])):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.gz").write_bytes(gzip.compress(b"".join(r + b"\r\n\r\n" for r in chosen)))
    r = warc.read_warc(spark, str(tmp_path / "whole")).first()
    assert bytes(r.payload) == payload and r.intact
    assert not warc.read_warc(spark, str(tmp_path / "missing"), strict=False).first().intact
    with pytest.raises(Exception, match="damaged record"):
        warc.read_warc(spark, str(tmp_path / "missing")).collect()


def test_nearest(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(600, 24)).astype(np.float32)
    vectors[100:300] = vectors[0]  # a large class of equal vectors
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(900, None), (950, [0.0] * 24), (951, [float("nan")] * 24), (952, [None] * 24), (953, [float("inf")] + [1.0] * 23), (1000, [1.0, 2.0]), (1001, [2.0, 4.0]), (1050, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = defaultdict(list)
    for r in crosspolytope.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    x = vectors.astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 600, 50):
        s = np.round(unit @ unit[q], 12)
        s[q] = -9
        want = np.lexsort((np.arange(600), -s))[:5]
        hit += len({i for i, _ in got[q]} & set(want.tolist()))
        assert all(abs(v - unit[i] @ unit[q]) < 1e-9 for i, v in got[q])
    assert hit >= 0.9 * 60
    assert [i for i, _ in got[0]] == [100, 101, 102, 103, 104] and [i for i, _ in got[150]] == [0, 100, 101, 102, 103]
    assert [i for i, _ in got[1000]] == [1001]
    assert not {900, 950, 1050} & set(got)
    assert crosspolytope.nearest(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def water_fill(sizes, weights, share=1.5, cap=2.0):
    want, targets, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = want - sum(targets[i] for i in range(len(sizes)) if i not in open_)
        level = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if level * weights[i] > cap * sizes[i]}
        for i in over or open_:
            targets[i] = cap * sizes[i] if over else level * weights[i]
        open_ -= over or open_
    return targets


def test_mixing(texts, docs, empty):
    rows = mixing.mix(docs).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((i, s, size(t)) for i, t, _, s in texts)
    total = defaultdict(int)
    for _, t, _, s in texts:
        total[s] += size(t)
    names = sorted(total, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(names, water_fill([total[n] for n in names], [(5, 2, 1)[k % 3] for k in range(len(names))])))
    taken = defaultdict(int)
    for r in rows:
        assert r.target == pytest.approx(wanted[r.source]) and r.source_size == total[r.source]
        assert 0 <= r.taken <= 2 * r.size
        assert (r.position is not None) + (r.position2 is not None) >= -(-r.taken // max(r.size, 1))
        taken[r.source] += r.taken
    assert all(abs(taken[n] - wanted[n]) <= 1 for n in names)
    assert {tuple(r) for r in mixing.mix(docs.repartition(2)).collect()} == {tuple(r) for r in rows}
    assert mixing.mix(empty).count() == 0
    order = [r.position for r in mixing.curriculum(docs).collect()]
    assert order == sorted(order) and 0 <= order[0] and order[-1] < 1


def test_schedules_invert(spark):
    for rank, knots in enumerate(mixing.SCHEDULES):
        shares = [k / 20 for k in range(21)]
        df = spark.createDataFrame([(s, rank) for s in shares], "s double, rank int")
        times = [r[0] for r in df.select(mixing.invert_schedule(F.col("s"), F.col("rank"))).collect()]
        grid = np.linspace(0, 1, 20001)
        w = np.interp(grid, *zip(*knots))
        area = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2)])
        assert np.allclose(np.interp(times, grid, area / area[-1]), shares, atol=1e-4)


def test_quality_counts(texts, docs, empty):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.quality(docs).collect())
    want = Counter()
    for i, t, *_ in texts:
        t = t or ""
        w = WORD.findall(t)
        windows = Counter(zip(w, w[1:], w[2:]))
        marked = {k + d for k in range(len(w) - 2) if windows[w[k], w[k + 1], w[k + 2]] > 1 for d in range(3)}
        lines, dup, seen = [x for x in t.split("\n") if WORD.search(x)], 0, set()
        for x in lines:
            dup += x in seen
            seen.add(x)
        want[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(marked), len(w) < 50 or 100 * len(marked) > 50 * len(w)] += 1
    assert got == want
    assert quality.quality(empty).count() == 0


def test_quality_outliers(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 9)))
    rows = []
    for k in range(400):
        w = [word() for _ in range(rng.randrange(60, 300))]
        if k % 20 == 0:
            w = [x + rng.choice(["###", "$$$", "%%%"]) for x in w]
        rows.append((k, " ".join(w), "en", "hot"))
    kept = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {k for k, v in kept.items() if not v} == set(range(0, 400, 20))


def brute_mcd(x):
    """Centre and inverse covariance of one group by concentration steps on all its rows."""
    floor = np.array(quality.FLOOR)
    low, middle, high = np.percentile(x, [25, 50, 75], 0, method="inverted_cdf")
    d2 = (((x - middle) / np.maximum((high - low) / 1.35, floor)) ** 2).sum(1)
    center = None
    for _ in range(quality.STEPS):
        kept = x[d2 <= np.quantile(d2, quality.H, method="inverted_cdf")]
        before, center = center, kept.mean(0)
        cov = np.cov(kept.T, bias=True) * quality.CONSISTENCY
        cov[range(4), range(4)] = np.maximum(cov[range(4), range(4)], floor**2)
        inverse = np.linalg.inv(cov)
        d2 = np.einsum("ij,jk,ik->i", x - center, inverse, x - center)
        if before is not None and np.abs(center - before).max() <= quality.STILL:
            break
    return center, inverse


def test_robust_distances(spark):
    rng = np.random.default_rng(6)
    groups = [("en", "a", 300), ("en", None, quality.MIN_GROUP), (None, "b", quality.MIN_GROUP - 1), ("de", "a", 40)]
    keys = [(lang, source) for lang, source, n in groups for _ in range(n)]
    shift = {k: v for k, v in zip(dict.fromkeys(keys), (0.0, 0.4, -0.3, 0.2))}
    x = rng.normal(0, [0.1, 0.4, 0.05, 0.3], (len(keys), 4)) + np.array([[shift[k]] * 4 for k in keys])
    x[:, 3] += 0.7 * x[:, 1]
    x[::17] += [1.0, 3.0, 0.0, -2.0]
    df = spark.createDataFrame([(k, *keys[k], *x[k].tolist()) for k in range(len(keys))], "doc_id long, lang string, source string, f0 double, f1 double, f2 double, f3 double").repartition(3)
    got = {r.doc_id: r.d2 for r in quality.outlier_distances(df).collect()}
    assert len(got) == len(keys)
    pooled = brute_mcd(x)
    for lang, source, n in groups:
        own = np.array([k == (lang, source) for k in keys])
        center, inverse = brute_mcd(x[own]) if n >= quality.MIN_GROUP else pooled
        want = np.einsum("ij,jk,ik->i", x[own] - center, inverse, x[own] - center)
        assert np.allclose([got[i] for i in np.flatnonzero(own).tolist()], want, rtol=1e-6, atol=1e-9)
        assert (want[np.flatnonzero(own) % 17 == 0] > quality.CUT).all()


def test_best_cuts_are_optimal():
    rng = random.Random(9)
    for _ in range(30):
        places = np.unique([0, *(rng.randrange(1, 60) for _ in range(14))])
        places = np.unique(np.concatenate([places, np.arange(0, int(places[-1]) + 1, 5)]))
        fee = np.array([0] + [rng.choice([0, 2, 6]) for _ in places[1:]])
        got = packing.best_cuts(places, fee, 16)
        worth = {int(p): int(f) for p, f in zip(places, fee)}
        price = lambda cuts: sum(16 - (b - a) + worth[b] for a, b in zip([0, *cuts], cuts))
        best = {0: 0}
        for b in places[1:].tolist():
            best[b] = min(best[a] + 16 - (b - a) + worth[b] for a in places.tolist() if a < b <= a + 16)
        assert price(got) == min(v for p, v in best.items() if p >= places[-1] - 16)
        assert all(0 < b - a <= 16 for a, b in zip([0, *got], got))


def test_packing_round_trip(texts, docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    ids = defaultdict(list)
    for i, t, *_ in texts:
        ids[i].append(np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4"))
    rows = packing.pack(docs).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in ids[r.doc_id])
    assert {i: sum(r.length for r in p) for i, p in pieces.items()} == {i: sum(map(len, x)) for i, x in ids.items()}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = total = 0
    for s in sequences.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 4096
        total += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding <= 0.1 * total
    assert packing.pack(empty).count() == 0


def test_words_are_tokenised_like_texts():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    text = "It's DON'T, a.b.. «x». ﬁne é. É. 12,5. <|endoftext|>. x<|endoftext|>y  z. '. ... I'LL. İ. ΣΣ. ẖ, H̱ ok,"
    rng = random.Random(3)
    signs = [*"aAbBzZ.,'!0 \n\t\x0b  éÉèÀß×÷İΣςﬁ漢字̱́HhÅ<|>$", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'S", "I'LL. "]
    texts = ["", text, *("".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(5000))]
    words = packing.Words(packing.tokenizer_path())
    got = words.encode([t.encode() for t in texts])
    assert [x.tolist() for x in got] == [tok.encode(t, add_special_tokens=False).ids + [packing.END] for t in texts]


def test_words_that_are_forgotten_are_encoded_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 40)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé.") for _ in range(rng.randrange(1, 4)))
    words = packing.Words(packing.tokenizer_path())
    for _ in range(20):
        texts = [" ".join(word() for _ in range(9)) for _ in range(8)]
        assert [x.tolist() for x in words.encode([t.encode() for t in texts])] == [words.tokenizer.encode(t, add_special_tokens=False).ids + [packing.END] for t in texts]
