"""N-gram Jaccard join by signature trees, and the groups of documents that it links.

Texts are split once: blocks hold documents as numbered words, with a 64-bit hash for each distinct word,
and every later step makes its shingles from these. A document's set is its distinct word shingles, as 64-bit
hashes. Equal sets become one class first. Two sets of similarity ``T`` or more share one of the first
``(1 - T)`` share of their shingles in any
order common to all. Of the shingles, one in ``SAMPLED`` is looked up in the whole corpus: those of
one document come first (and can't link), those of several last, so that a shared passage links no
documents which have enough of their own; else shingles of rare words come first. Classes that share such a shingle and
whose sizes fit are put in one cell; a cell is a connected part of that relation and no link leaves it.
Cells stand for the upper levels of the tree: signatures of unrelated documents, OR-combined, would hold
every bit and prune nothing. Only the sets of cells of two classes or more travel.

Within a cell a signature tree finds the links: leaves hold the token bitmaps and sizes of documents,
inner nodes the OR of their bitmaps and the range of their sizes. A dual traversal drops pairs of
nodes whose largest possible overlap is below what their sizes require; surviving pairs are verified
on the full sets, unless they are connected already, as only the groups are asked for.

Cells of more than a page are mostly documents that a passage strings together, and grow faster than the
corpus. Their shingles are all counted, and the rarest among these documents form prefixes and cells anew, so that
passages come last. What is still large is copies of one text; it is dealt over pages, and every page first meets
the cell's first page. Those that this leaves in several groups form smaller cells, by neighbouring bands of
sizes, in which pages meet that hold different groups.

Word frequencies are those of words that stand ``OFTEN`` times in a block of documents, at most
``FREQUENT`` of them; they decide on speed alone, never on results.

Defined results: words are runs of other characters than ASCII blanks, A-Z in lower case; texts with
fewer words than a shingle are one shingle of all their words; null or wordless texts have none
and stay alone; a null doc_id comes before others; rows of one doc_id are one document in the groups;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, NULL_ID, by_key, mixed, record_batch, settle, shuffle_width, small_batches, stage, stream_by, word_array
from .components import components
from .runindex import ANCHORS, BUCKET_BYTES, FOUND, bucket_count, repeated_hashes

FREQUENT = 1 << 17
#: Times that a word stands in a block from which it takes part in the count of frequent words.
OFTEN = 4
PAGE = 400_000  # shingles of a page
LEAF = 8
#: One shingle in so many is looked up in the whole corpus.
SAMPLED = np.uint64(3)
BLOCKS = "block long, raw_bytes long, ids binary, counts binary, words binary, codes binary, often binary"
FEATURES = "doc_id long, block long, place int, n_shingles long, s1 long, s2 long, prefix array<long>"
SETS = "doc_id long, block long, cell long, pages long, page long, shingles binary"
LEVELS = "block long, hashes binary, levels binary"
PREFIXES = "doc_id long, n_shingles long, prefix array<long>"
LINKS = "a long, b long"
PRIME = np.uint64(0x9E3779B97F4A7C15)


def _to_blocks(size: int):
    """Blocks of documents as numbered words: the hashes of the block's distinct words, and a number for each word."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        texts: list[bytes] = []
        held = 0

        def block() -> pa.RecordBatch:
            counts, words = word_array(texts, lower=True)
            coded = words.dictionary_encode()
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
            codes = coded.indices.to_numpy().astype("<u4")
            times = np.bincount(codes, minlength=len(hashes))
            often = np.flatnonzero(times >= OFTEN)
            rows = [(part << 33 | serial, held, np.array(ids, np.int64).tobytes(), counts.tobytes(), hashes.tobytes(), zstandard.compress(codes.tobytes(), 1), np.stack([hashes[often].view(np.int64), times[often]]).tobytes())]
            return record_batch(rows, BLOCKS)

        for batch in batches:
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                ids.append(i)
                texts.append(t or b"")
                held += len(texts[-1])
                if held >= size or len(ids) >= 1 << 17:
                    yield block()
                    serial, held = serial + 1, 0
                    ids.clear()
                    texts.clear()
        if ids:
            yield block()

    return build


def shingle_row(h: np.ndarray, words_each: int) -> np.ndarray:
    """Hashes of all shingles in the order of the text."""
    n = len(h)
    if not n:
        return h
    k = min(n, words_each)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ h[i : n - k + 1 + i]) * PRIME
        out ^= out >> np.uint64(29)
    return mixed(out)


class Shingles:
    """The shingles of a block's documents, one document after the other, in the order of the texts."""

    def __init__(self, row: dict, words_each: int):
        self.ids, counts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.int64)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.codes = np.frombuffer(zstandard.decompress(row["codes"]), "<u4")
        h = self.words[self.codes]
        self.width = np.minimum(counts, words_each)
        self.own = counts - self.width + (counts > 0)
        self.ends = np.cumsum(self.own)
        self.doc = np.repeat(np.arange(len(counts)), self.own)
        #: Number of the word at which each shingle starts.
        begins = np.cumsum(counts) - counts
        self.at = np.repeat(begins - (self.ends - self.own), self.own) + np.arange(self.own.sum())
        whole = shingle_row(h, words_each) if len(h) >= words_each else np.empty(0, np.uint64)
        self.values = whole[np.minimum(self.at, max(len(whole) - 1, 0))] if len(whole) else np.zeros(len(self.at), np.uint64)
        for k in np.flatnonzero((counts > 0) & (counts < words_each)).tolist():
            self.values[self.ends[k] - 1] = shingle_row(h[begins[k] : begins[k] + counts[k]], words_each)[0]

    def distinct(self) -> np.ndarray:
        """Places of each document's distinct shingles, in the order of documents and then of hashes."""
        if not len(self.values):
            return np.empty(0, np.int64)
        order = np.concatenate([a + np.argsort(self.values[a:b]) for a, b in zip((self.ends - self.own).tolist(), self.ends.tolist()) if b > a])
        v = self.values[order]
        return order[np.append(True, (v[1:] != v[:-1]) | (self.doc[order[1:]] != self.doc[order[:-1]]))]


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for own in batch.column("often").to_pylist():
            words, counts = np.frombuffer(own, np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts)], ["word", "n"])


class Weights:
    """Logarithms of word counts, 0 for words that aren't frequent."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        order = np.argsort(words)
        self.words = words[order]
        self.weights = np.round(8 * np.log2(counts[order] + 1)).astype(np.int64)
        self.low = np.zeros(1 << 20, bool)
        self.low[(self.words & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def of(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.int64)
        maybe = np.flatnonzero(self.low[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.words, h[maybe]), len(self.words) - 1)
            out[maybe] = np.where(self.words[at] == h[maybe], self.weights[at], 0)
        return out


def _sampled(words_each: int, buckets: int):
    """The block's sampled shingles, and whether one or more of its documents hold each."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            x = Shingles(row, words_each)
            own = np.flatnonzero(x.values % SAMPLED == 0)
            if not len(own):
                continue
            own = own[np.argsort(x.values[own], kind="stable")]  # those of one document stay together
            values, docs = x.values[own], x.doc[own]
            at = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
            several = docs[at] != docs[np.append(at[1:], len(own)) - 1]
            goal = ((values[at] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(goal, kind="stable")
            cuts = np.flatnonzero(np.diff(goal[order], prepend=-1)).tolist() + [len(order)]
            rows = [(int(goal[order[a]]), row["block"], values[at[order[a:b]]].tobytes(), (1 + several[order[a:b]]).astype(np.uint8).tobytes()) for a, b in zip(cuts, cuts[1:])]
            if rows:
                yield record_batch(rows, ANCHORS)

    return sampled


def _features(words_each: int, percent: int, words: np.ndarray, counts: np.ndarray):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(words, counts)
        for row in (row for batch in batches for row in batch.to_pylist()):
            x = Shingles(row, words_each)
            shared = np.unique(np.concatenate([np.frombuffer(f, np.uint64) for f in row["found"] or [b""]]))
            at = x.distinct()
            u, doc, docs = x.values[at], x.doc[at], len(x.ids)
            n = np.bincount(doc, minlength=docs)
            ends = np.cumsum(n)
            sums = lambda v: np.diff(np.append(np.uint64(0), np.cumsum(v))[np.append(0, ends)]).view(np.int64)
            # shingles known to be of one document come first, those known to be of several last
            rank = np.ones(len(u), np.int8)
            known = np.flatnonzero(u % SAMPLED == 0)
            rank[known] = 2 * np.isin(u[known], shared)
            alone = np.bincount(doc[rank == 0], minlength=docs)
            # a shingle of one document meets no other, so only the rest of a prefix is kept
            rest = np.where(n > 0, prefix_length(n, percent), 0) - alone
            weight = np.cumsum(np.append(0, weights.of(x.words)[x.codes]))
            prefixes = [np.empty(0, np.uint64)] * docs
            for k in np.flatnonzero(rest > 0).tolist():
                own = np.arange(ends[k] - n[k], ends[k])
                own = own[rank[own] > 0]
                heavy = weight[x.at[at[own]] + x.width[k]] - weight[x.at[at[own]]]
                prefixes[k] = u[own[np.lexsort((heavy, rank[own]))[: rest[k]]]]  # ties in the order of the hashes
            lengths = np.cumsum([0] + [len(v) for v in prefixes])
            lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate([*prefixes, np.empty(0, np.uint64)]).view(np.int64)))
            columns = [pa.array(x.ids), pa.array(np.full(docs, row["block"], np.int64)), pa.array(np.arange(docs, dtype=np.int32)), pa.array(n.astype(np.int64)), pa.array(sums(u)), pa.array(sums(mixed(u ^ PRIME))), lists]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in FEATURES.split(", ")])

    return features


def _word_blocks(docs: DataFrame) -> DataFrame:
    return stage(docs.mapInArrow(_to_blocks(BLOCK_BYTES), BLOCKS), "word-blocks")


def _ordered_prefixes(blocks: DataFrame, words_each: int, percent: int) -> DataFrame:
    """FEATURES of every document: where it is, the size of its set, two sums that tell sets apart, and its rarest shingles."""
    spark = blocks.sparkSession
    counts = blocks.select("often").mapInArrow(_frequent, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # at most FREQUENT rows, whatever the corpus
    common = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    words, often = np.array([r[0] for r in common], np.int64).view(np.uint64), np.array([r[1] for r in common], np.int64)
    buckets = bucket_count(blocks)
    dealt = stream_by(blocks.mapInArrow(_sampled(words_each, buckets), ANCHORS), "bucket", min(buckets, shuffle_width(spark)), repeated_hashes, FOUND)
    # bounded by what the block sent; staged, so that what was sent is gone when the blocks travel
    found = stage(dealt.groupBy("block").agg(F.collect_list("hashes").alias("found")), "shingles-found")
    return blocks.join(found.hint("merge"), "block", "left").mapInArrow(_features(words_each, percent, words, often), FEATURES)


def _sets(words_each: int):
    """SETS of those of a block's documents that are asked for."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            x = Shingles(row, words_each)
            out, held = [], 0
            for m in row["members"]:
                k = m["place"]
                own = np.unique(x.values[x.ends[k] - x.own[k] : x.ends[k]]).tobytes()
                out.append((int(x.ids[k]), row["block"], m["cell"], m["pages"], m["page"], own))
                held += len(own)
                if held > 4 << 20:
                    yield record_batch(out, SETS)
                    out, held = [], 0
            if out:
                yield record_batch(out, SETS)

    return sets


def _held(buckets: int):
    """How many of the pack's sets hold each shingle, up to 255."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            values, times = np.unique(np.concatenate([np.frombuffer(x["shingles"], np.uint64) for x in row["sets"]]), return_counts=True)
            goal = ((values >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(goal, kind="stable")
            cuts = np.flatnonzero(np.diff(goal[order], prepend=-1)).tolist() + [len(order)]
            rows = [(int(goal[order[a]]), row["block"], values[order[a:b]].tobytes(), np.minimum(times[order[a:b]], 255).astype(np.uint8).tobytes()) for a, b in zip(cuts, cuts[1:])]
            yield record_batch(rows, ANCHORS)

    return held


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers each pack with those of its shingles that several sets hold, and the logarithm of how many."""
    for _, rows in by_key(batches, "bucket"):
        hashes = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
        values, place = np.unique(np.concatenate(hashes), return_inverse=True)
        times = np.bincount(place, weights=np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in rows]), minlength=len(values))
        level = np.minimum(np.round(8 * np.log2(times)), 255).astype(np.uint8)[place]
        out, k = [], 0
        for r, h in zip(rows, hashes):
            own = level[k : k + len(h)]
            k += len(h)
            if own.any():
                out.append((r["block"], h[own > 0].tobytes(), own[own > 0].tobytes()))
        if out:
            yield record_batch(out, LEVELS)


def _rarest(percent: int):
    """PREFIXES of the sets of each pack: their rarest shingles, without those of one set only."""

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            known = np.concatenate([np.empty(0, np.uint64)] + [np.frombuffer(f["hashes"], np.uint64) for f in row["found"] or []])
            level = np.concatenate([np.zeros(0, np.uint8)] + [np.frombuffer(f["levels"], np.uint8) for f in row["found"] or []])
            order = np.argsort(known)
            known, level = known[order], level[order]
            ids, sizes, prefixes = [], [], []
            for x in row["sets"]:
                u = np.frombuffer(x["shingles"], np.uint64)
                own = np.zeros(len(u), np.uint8)
                if len(known):
                    at = np.minimum(np.searchsorted(known, u), len(known) - 1)
                    own = np.where(known[at] == u, level[at], 0)
                first = np.argsort(own, kind="stable")[: prefix_length(len(u), percent)]  # ties in the order of the hashes
                ids.append(x["doc_id"])
                sizes.append(len(u))
                prefixes.append(u[first[own[first] > 0]].view(np.int64))
            lists = pa.array(prefixes, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), lists], [f.split()[0] for f in PREFIXES.split(", ")])

    return rarest


def _stars(percent: int):
    """Pairs that connect the documents of one shingle whose sizes fit, from rows sorted by shingle and size."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = hub = hub_n = last = last_n = None
        for batch in batches:
            out = set()
            for t, n, d in zip(*(batch.column(c).to_pylist() for c in ("token", "n", "doc"))):
                if t != token:
                    token, hub, hub_n = t, d, n
                elif 100 * hub_n >= percent * n:
                    out.add((hub, d))
                else:
                    if 100 * last_n >= percent * n:
                        out.add((last, d))
                    hub, hub_n = d, n
                last, last_n = d, n
            if out:
                yield record_batch([(a, b) for a, b in out if a != b], LINKS)

    return stars


class Groups:
    """Union-find over small numbers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.parent[self.find(i)] = self.find(j)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    inter = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * inter >= percent * (len(x) + len(y) - inter)


class SignatureTree:
    """Sets sorted by size; nodes of ``LEAF`` children with OR-combined bitmaps and size ranges."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
        self.sets = [sets[i] for i in self.order]
        size = np.array([len(s) for s in self.sets], np.int64)
        bits = 1 << max(6, min(15, int(2 * size.max(initial=1)).bit_length()))
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for row, s in zip(maps, self.sets):
            own = np.zeros(bits, bool)
            own[(s & np.uint64(bits - 1)).astype(np.int64)] = True
            row[:] = np.packbits(own).view(np.uint64)
        # what hashing into the bitmap can hide: the tokens of a set beyond its bits
        spare = size - np.bitwise_count(maps).sum(1).astype(np.int64)
        self.levels = [(maps, size, size, spare)]
        while len(self.levels[-1][0]) > LEAF:
            maps, low, high, spare = self.levels[-1]
            at = np.arange(0, len(maps), LEAF)
            self.levels.append((np.bitwise_or.reduceat(maps, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(spare, at)))

    def _may_link(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Matrix of the pairs of nodes whose largest possible overlap is enough for their sizes."""
        maps, low, high, spare = self.levels[level]
        possible = np.bitwise_count(maps[a][:, None] & maps[b][None]).sum(2, dtype=np.int64) + np.minimum(spare[a][:, None], spare[b][None])
        needed = self.percent * (low[a][:, None] + low[b][None])
        sizes = (100 * high[a][:, None] >= self.percent * low[b][None]) & (100 * high[b][None] >= self.percent * low[a][:, None])
        return sizes & ((100 + self.percent) * possible >= needed)

    def links(self, groups: Groups) -> Iterator[tuple[int, int]]:
        """Links found that join groups (numbers of the sets given); ``groups`` is updated."""
        top = len(self.levels) - 1
        every = np.arange(len(self.levels[top][0]))
        waiting = [(top, every, every)]
        while waiting:
            level, a, b = waiting.pop()
            for i, j in zip(*np.nonzero(self._may_link(level, a, b))):
                x, y = int(a[i]), int(b[j])
                if x > y:
                    continue
                if level:
                    n = len(self.levels[level - 1][0])
                    waiting.append((level - 1, np.arange(x * LEAF, min(n, (x + 1) * LEAF)), np.arange(y * LEAF, min(n, (y + 1) * LEAF))))
                elif x != y:
                    p, q = self.order[x], self.order[y]
                    if groups.find(p) != groups.find(q) and linked(self.sets[x], self.sets[y], self.percent):
                        groups.join(p, q)
                        yield p, q


def _verify(percent: int):
    """Links within each task's sets; those of one ``label`` are known to be connected."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_key(batches, "task"):
            sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
            groups = Groups(len(rows))
            known: dict[int, int] = {}
            for k, r in enumerate(rows):
                groups.join(k, known.setdefault(r["label"], k))
            out = [(rows[p]["doc_id"], rows[q]["doc_id"]) for p, q in SignatureTree(sets, percent).links(groups)]
            if out:
                yield record_batch(out, LINKS)

    return verify


def _run_tasks(tasks: DataFrame, percent: int, tag: str) -> DataFrame:
    dealt = tasks.select("task", "doc_id", "label", "shingles").repartition(4 * shuffle_width(tasks.sparkSession), "task").sortWithinPartitions("task")
    return stage(dealt.mapInArrow(_verify(percent), LINKS), tag)


def jaccard_groups(docs: DataFrame, words_each: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links of similarity of at least
    ``percent`` / 100 lead to."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return settle(spark, lambda: _groups(docs, words_each, percent), "jaccard-groups")


def _groups(docs: DataFrame, words_each: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    blocks = _word_blocks(docs)
    features = stage(_ordered_prefixes(blocks, words_each, percent), "shingle-features")
    key = ["n_shingles", "s1", "s2"]
    first = F.min(F.struct("doc_id", "block", "place", "prefix")).alias("first")
    classes = features.where("n_shingles > 0").groupBy(*key).agg(first)
    classes = stage(classes.select(*key, F.col("first.doc_id").alias("rep"), "first.block", "first.place", "first.prefix"), "shingle-classes")
    groups = settle(spark, lambda: _class_groups(blocks, classes, words_each, percent), "class-groups")
    named = classes.join(groups.withColumnsRenamed({"node": "rep"}), "rep", "left").select(*key, F.coalesce("component", "rep").alias("component"))
    joined = features.select("doc_id", *key).join(named.hint("merge"), key, "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return joined.select(real("doc_id"), "n_shingles", real("component_id"))


def _near(postings: DataFrame, percent: int) -> DataFrame:
    """Pairs that connect all that share a shingle and fit in size; ``postings`` is (token, n, doc)."""
    dealt = postings.repartition(2 * shuffle_width(postings.sparkSession), "token").sortWithinPartitions("token", "n", "doc")
    return dealt.mapInArrow(_stars(percent), LINKS).distinct()


def _postings(prefixes: DataFrame, doc: str) -> DataFrame:
    return prefixes.select(F.explode("prefix").alias("token"), F.col("n_shingles").alias("n"), F.col(doc).alias("doc"))


def _cell_members(classes: DataFrame, percent: int) -> DataFrame:
    """(node, component, n_shingles, block, place): the classes that share a shingle of their prefixes with another, by cell."""
    cells = components(stage(_near(_postings(classes, "rep"), percent), "cell-edges"))
    return cells.join(classes.select(F.col("rep").alias("node"), "n_shingles", "block", "place"), "node")


def _page_counts(members: DataFrame) -> DataFrame:
    return members.groupBy("component").agg(F.ceil(F.sum("n_shingles") / PAGE).alias("pages"))


def _first_links(sets: DataFrame, percent: int, tag: str) -> DataFrame:
    """Links within cells of one page, and between the first page and every page of the others."""
    others = F.when((F.col("page") == 0) & (F.col("pages") > 1), F.sequence(F.lit(1), F.col("pages") - 1)).otherwise(F.array(F.col("page")))
    first = sets.withColumn("other", F.explode(others)).withColumn("task", F.xxhash64("cell", "other")).withColumn("label", F.col("doc_id"))
    return _run_tasks(first, percent, tag)


def _banded_links(large: DataFrame, found: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Links between the groups that their first page leaves large cells in.

    Sets link within a band of sizes or to the next band only, so these classes form new cells for every
    two neighbouring bands. Those in which one group is left are done. In the others a group of a page or more
    has pages of its own, which needn't meet each other, and smaller groups share pages.
    """
    labelled = large.select("doc_id", "cell").join(found.withColumnsRenamed({"node": "doc_id", "component": "label"}), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    labelled = stage(labelled.distinct(), "cell-labels")
    split = labelled.groupBy("cell").agg((F.min("label") != F.max("label")).alias("split")).where("split").select("cell")
    rest = stage(labelled.join(split, "cell", "left_semi").join(prefixes.select("doc_id", "n_shingles", "prefix"), "doc_id"), "cell-rest")
    # a little wider than what may link, so that rounding parts no two
    band = F.floor(F.log("n_shingles") / math.log(1.01 * 100 / percent))
    banded = rest.withColumn("band", F.explode(F.array(band - 1, band))).withColumn("node", F.xxhash64("doc_id", "band"))
    tokens = banded.select(F.explode("prefix").alias("token"), "band", F.col("n_shingles").alias("n"), F.col("node").alias("doc")).withColumn("token", F.xxhash64("token", "band")).drop("band")
    cells = components(stage(_near(tokens, percent), "band-edges"))
    members = stage(banded.select("node", "doc_id", "label", "n_shingles").join(cells, "node"), "band-members")
    split = members.groupBy("component").agg((F.min("label") != F.max("label")).alias("split")).where("split").select("component")
    groups = members.join(split, "component", "left_semi").groupBy("component", "label").agg(F.sum("n_shingles").alias("n"))
    groups = groups.withColumn("own", F.when(F.col("n") >= PAGE, F.col("label")))  # null: shares its pages
    counts = groups.groupBy("component", "own").agg(F.ceil(F.sum("n") / PAGE).alias("pages"))
    groups = stage(groups.join(counts.withColumnsRenamed({"component": "c", "own": "o"}), (F.col("component") == F.col("c")) & F.col("own").eqNullSafe(F.col("o"))).select("component", "label", "own", "pages"), "band-groups")
    paged = members.join(groups, ["component", "label"]).withColumn("page", F.pmod(F.xxhash64("doc_id"), F.col("pages")))
    paged = stage(paged.select("doc_id", "label", "component", "own", F.xxhash64("own", "page").alias("page")), "band-pages")
    pages = paged.select("component", "own", "page").distinct()
    x, y = pages.withColumnsRenamed({"own": "x_own", "page": "x"}), pages.withColumnsRenamed({"own": "y_own", "page": "y"})
    pairs = x.join(y, "component").where("x < y and (x_own is null or y_own is null or x_own != y_own) or x = y and x_own is null")
    # a shared page that meets another needn't meet itself besides
    pairs = pairs.withColumn("alone", F.max(F.when(F.col("x") != F.col("y"), 1).otherwise(0)).over(Window.partitionBy("component")) == 0).where("x != y or alone")
    meets = pairs.select("component", F.xxhash64("component", "x", "y").alias("task"), F.explode(F.array_distinct(F.array("x", "y"))).alias("page"))
    tasks = stage(paged.join(meets, ["component", "page"]).select(F.col("doc_id").alias("node"), "label", "task").distinct(), "band-tasks")
    return _run_tasks(large.select("doc_id", "shingles").join(tasks.hint("merge"), F.col("doc_id") == F.col("node")), percent, "links-second")


def _large_links(large: DataFrame, percent: int) -> DataFrame:
    """Links within cells of several pages, by prefixes of the shingles that are rarest in these."""
    spark = large.sparkSession
    packs = stage(large.groupBy("block").agg(F.collect_list(F.struct("doc_id", "shingles")).alias("sets")), "large-packs")  # bounded by the block's documents
    sent = packs.select(F.sum(F.aggregate("sets", F.lit(0).cast("long"), lambda n, x: n + F.length(x["shingles"])))).first()[0]
    buckets = max(1, math.ceil(sent / BUCKET_BYTES))
    dealt = stream_by(packs.mapInArrow(_held(buckets), ANCHORS), "bucket", min(buckets, shuffle_width(spark)), _levels, LEVELS)
    found = stage(dealt.groupBy("block").agg(F.collect_list(F.struct("hashes", "levels")).alias("found")), "large-found")
    prefixes = stage(packs.join(found.hint("merge"), "block", "left").mapInArrow(_rarest(percent), PREFIXES), "large-prefixes")
    cells = components(stage(_near(_postings(prefixes, "doc_id"), percent), "large-edges"))
    members = stage(cells.join(prefixes.select(F.col("doc_id").alias("node"), "n_shingles"), "node"), "large-members")
    paged = members.join(_page_counts(members), "component").select("node", F.col("component").alias("cell"), "pages", F.pmod(F.xxhash64("node"), F.col("pages")).alias("page"))
    sets = stage(large.select("doc_id", "shingles").join(paged.hint("merge"), F.col("doc_id") == F.col("node")).drop("node"), "large-sets")
    links = _first_links(sets, percent, "links-large")
    several = sets.where("pages > 1")
    if several.isEmpty():
        return links
    return links.unionByName(settle(spark, lambda: _banded_links(several, components(links), prefixes, percent), "links-banded"))


def _class_groups(blocks: DataFrame, classes: DataFrame, words_each: int, percent: int) -> DataFrame:
    """(node, component) of the classes that have links."""
    spark = blocks.sparkSession
    members = settle(spark, lambda: _cell_members(classes, percent), "cell-members")
    member = F.struct("place", F.col("component").alias("cell"), "pages", F.pmod(F.xxhash64("node"), F.col("pages")).alias("page"))
    asked = members.join(_page_counts(members), "component").groupBy("block").agg(F.collect_list(member).alias("members"))  # bounded by the block's documents
    sets = stage(blocks.join(asked.hint("merge"), "block").mapInArrow(_sets(words_each), SETS), "cell-sets")
    links = _first_links(sets.where("pages = 1"), percent, "links-small")
    large = sets.where("pages > 1")
    if not large.isEmpty():
        links = links.unionByName(settle(spark, lambda: _large_links(large, percent), "links-of-large"))
    return components(links)
