"""Word-window deduplication with super-k-mers.

A window is ``WINDOW`` consecutive words of one document. Its minimiser is the smallest hash of its
``MINIMISER``-word substrings; consecutive windows that share it travel as one packed string to the
bucket of that minimiser, so equal windows always meet. A bucket sorts its windows and counts them
exactly: windows are ordered by a hash, and equal hashes are compared word by word. Minimisers that
stand in one document alone can't belong to such a window; a first exchange, of 32 bits each, tells
the blocks which of theirs stand in several, and only those strings travel.

Documents lie in compressed blocks. A block sends every distinct packed string once, with its smallest
document (the block itself knows the fate of the others), grouped by bucket and compressed. Buckets
answer each block with a mask of removed windows per string; the block then removes the words.
Nothing depends on how often a window occurs: a passage found in every document is one string a block.

Defined results: a null text has no words; a null doc_id comes before all others; documents of one
doc_id don't remove from each other; texts with fewer words than a window stay as they are; an empty
table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_table, by_key, mixed, open_block, real_id, record_batch, shuffle_width, sliding_min, stage, stream_by

WINDOW = 13
MINIMISER = 5
#: Text bytes in a block, and behind a bucket.
BLOCK = 5 << 20
BUCKET_BYTES = 8 << 20
LONGEST = 32  # windows in a packed string: the bits of a mask
CACHE = 500_000
PRIME = np.uint64(0x9E3779B97F4A7C15)
SEEN = "bucket long, block long, marks binary, least binary, twice binary"
FOUND = "block long, bucket long, marks binary"
SENT = "bucket long, block long, docs binary, tags binary, windows binary, strings binary"
VERDICTS = "block long, tags binary, masks binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary"


class Hashes(dict):
    """64-bit hashes of words, remembered up to a number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Codes(dict):
    """Numbers words in the order of their first meeting."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Strings:
    """The packed strings of a block; the same for the same block whenever it is made."""

    def __init__(self, row: dict, hashes: Hashes, pack: bool = True):
        self.ids, ends, data = open_block(row["ids"], row["lengths"], row["texts"])
        self.words: list[bytes] = []
        counts, begin = [], 0
        for end in ends.tolist():
            own = data[begin:end].split()
            self.words += own
            counts.append(len(own))
            begin = end
        n = len(self.words)
        self.counts = np.array(counts, np.int64)
        doc = np.repeat(np.arange(len(counts)), self.counts)
        self.rows = np.empty(0, np.int64)
        if n >= WINDOW:
            h = np.fromiter(map(hashes.__getitem__, self.words), np.uint64, n)
            gram = np.zeros(n - MINIMISER + 1, np.uint64)
            for k in range(MINIMISER):
                gram = (gram ^ h[k : n - MINIMISER + 1 + k]) * PRIME
                gram ^= gram >> np.uint64(29)
            least = sliding_min(mixed(gram), WINDOW - MINIMISER + 1)
            self.rows = np.flatnonzero(doc[: n - WINDOW + 1] == doc[WINDOW - 1 :])
        if not len(self.rows):
            self.starts = self.windows = self.doc = self.first = np.empty(0, np.int64)
            self.keys, self.strings = np.empty(0, np.uint64), []
            return
        key = least[self.rows]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (self.rows[1:] != self.rows[:-1] + 1)
        begins = np.flatnonzero(new)
        inside = np.arange(len(key)) - np.repeat(begins, np.diff(np.append(begins, len(key))))
        at = np.flatnonzero(inside % LONGEST == 0)
        self.windows = np.diff(np.append(at, len(key)))
        self.starts, self.keys = self.rows[at], key[at]
        self.doc = doc[self.starts]
        if not pack:
            return
        line = b" ".join(self.words)
        offset = np.zeros(n + 1, np.int64)
        np.cumsum(np.fromiter(map(len, self.words), np.int64, n) + 1, out=offset[1:])
        stops = offset[self.starts + self.windows + WINDOW - 1] - 1
        self.strings = [line[a:b] for a, b in zip(offset[self.starts].tolist(), stops.tolist())]
        seen: dict[bytes, int] = {}
        self.first = np.fromiter((seen.setdefault(s, k) for k, s in enumerate(self.strings)), np.int64, len(self.strings))


def marks(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each minimiser, and 32 bits of it: they tell those of one bucket apart nearly always,
    and where they don't, a string travels for nothing."""
    return (keys % np.uint64(buckets)).astype(np.int64), (keys // np.uint64(buckets)).astype(np.uint32)


def _by_bucket(goal: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    order = np.argsort(goal, kind="stable")
    cuts = np.flatnonzero(np.diff(goal[order], prepend=-1)).tolist() + [len(order)]
    return order, list(zip(cuts, cuts[1:]))


def _seen(buckets: int):
    """The block's minimisers with the first and the last document that each stands in."""

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for row in batch.to_pylist():
                s = Strings(row, hashes, pack=False)
                order = np.argsort(s.keys, kind="stable")  # documents rise within a key
                key, doc = s.keys[order], s.ids[s.doc[order]]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
                last = np.append(first[1:] - 1, len(key) - 1) if len(key) else first
                goal, mark = marks(key[first], buckets)
                least, twice = doc[first], doc[first] != doc[last]
                order, cuts = _by_bucket(goal)
                rows = [(int(goal[order[a]]), row["block"], mark[order[a:b]].tobytes(), zstandard.compress(least[order[a:b]].tobytes(), 1), np.packbits(twice[order[a:b]]).tobytes()) for a, b in cuts]
                if rows:
                    yield record_batch(rows, SEEN)

    return seen


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers each block with those of its minimisers that stand in several documents."""
    for bucket, rows in by_key(batches, "bucket"):
        mark = [np.frombuffer(r["marks"], np.uint32) for r in rows]
        least = np.concatenate([np.frombuffer(zstandard.decompress(r["least"]), np.int64) for r in rows])
        twice = np.concatenate([np.unpackbits(np.frombuffer(r["twice"], np.uint8), count=len(m)) for r, m in zip(rows, mark)]).astype(bool)
        values, place = np.unique(np.concatenate(mark), return_inverse=True)
        low = np.full(len(values), np.iinfo(np.int64).max)
        np.minimum.at(low, place, least)
        several = np.zeros(len(values), bool)
        several[place[twice | (least != low[place])]] = True
        out, k = [], 0
        for r, m in zip(rows, mark):
            hit = several[place[k : k + len(m)]]
            k += len(m)
            if hit.any():
                out.append((r["block"], bucket, m[hit].tobytes()))
        if out:
            yield record_batch(out, FOUND)


def _send(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for row in batch.to_pylist():
                if not row["found"]:
                    continue
                s = Strings(row, hashes)
                goal, mark = marks(s.keys, buckets)
                wanted = np.concatenate([np.frombuffer(f["marks"], np.uint32).astype(np.int64) | f["bucket"] << 32 for f in row["found"]])
                # documents rise in a block: the first of equal strings has the smallest id
                own = np.flatnonzero((s.first == np.arange(len(s.strings))) & np.isin(mark.astype(np.int64) | goal << 32, wanted))
                order, cuts = _by_bucket(goal[own])
                rows = []
                for a, b in cuts:
                    k = own[order[a:b]]
                    rows.append((int(goal[k[0]]), row["block"], zstandard.compress(s.ids[s.doc[k]].tobytes(), 1), k.astype(np.uint32).tobytes(), s.windows[k].astype(np.uint8).tobytes(), zstandard.compress(b"\n".join([s.strings[i] for i in k.tolist()]), 3)))
                if rows:
                    yield record_batch(rows, SENT)

    return send


def removed_windows(words: list[bytes], windows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which windows of the packed strings also start in a smaller document; one entry per window."""
    codes = Codes()
    code = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, codes), np.uint64, len(codes))[code]
    n = len(words) - WINDOW + 1
    total = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        total = (total ^ h[k : n + k]) * PRIME
        total ^= total >> np.uint64(29)
    size = windows + WINDOW - 1
    count = int(windows.sum())
    at = np.repeat(np.cumsum(size) - size - (np.cumsum(windows) - windows), windows) + np.arange(count)
    doc = np.repeat(docs, windows)
    key = total[at]
    order = np.argsort(key)
    firsts = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    group = np.empty(count, np.int64)
    group[order] = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, count)))
    # equal hashes are compared word by word
    shared = np.flatnonzero(np.diff(np.append(firsts, count))[group] > 1)
    model = at[order[firsts]][group[shared]]
    same = np.ones(len(shared), bool)
    for k in range(WINDOW):
        same &= code[at[shared] + k] == code[model + k]
    if not same.all():  # different windows of one hash
        mixed_up = np.flatnonzero(np.isin(group, group[shared[~same]]))
        exact = np.stack([code[at[mixed_up] + k] for k in range(WINDOW)], 1)
        group[mixed_up] = len(firsts) + np.unique(exact, axis=0, return_inverse=True)[1].reshape(-1)
    least = np.full(int(group.max(initial=0)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, doc)
    return doc > least[group]


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in by_key(batches, "bucket"):
        words: list[bytes] = []
        for r in rows:
            words += zstandard.decompress(r["strings"]).split()
        windows = np.concatenate([np.frombuffer(r["windows"], np.uint8) for r in rows]).astype(np.int64)
        docs = np.concatenate([np.frombuffer(zstandard.decompress(r["docs"]), np.int64) for r in rows])
        gone = removed_windows(words, windows, docs)
        first = np.cumsum(windows) - windows
        bit = np.arange(len(gone)) - np.repeat(first, windows)
        masks = np.add.reduceat(gone.astype(np.int64) << bit, first)
        out, k = [], 0
        for r in rows:
            tags = np.frombuffer(r["tags"], np.uint32)
            mask = masks[k : k + len(tags)]
            k += len(tags)
            hit = mask > 0
            if hit.any():
                out.append((r["block"], tags[hit].tobytes(), mask[hit].astype(np.uint32).tobytes()))
        if out:
            yield record_batch(out, VERDICTS)


def _remove(keep_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for row in batch.to_pylist():
                s = Strings(row, hashes)
                mask = np.zeros(len(s.strings), np.int64)
                for v in row["verdicts"] or ():
                    mask[np.frombuffer(v["tags"], np.uint32)] = np.frombuffer(v["masks"], np.uint32)
                # a repeated string of the block goes whole if a smaller document of the block has it
                mask = np.where(s.ids[s.doc] > s.ids[s.doc[s.first]], np.int64((1 << LONGEST) - 1), mask[s.first]) if len(mask) else mask
                bit = np.arange(len(s.rows)) - np.repeat(np.cumsum(s.windows) - s.windows, s.windows)
                gone = s.rows[(np.repeat(mask, s.windows) >> bit) & 1 == 1]
                edge = np.zeros(len(s.words) + WINDOW + 1, np.int64)
                np.add.at(edge, gone, 1)
                np.add.at(edge, gone + WINDOW, -1)
                covered = (np.cumsum(edge)[: len(s.words)] > 0)
                out, a = [], 0
                for i, n in zip(s.ids.tolist(), s.counts.tolist()):
                    own = covered[a : a + n]
                    words = s.words[a : a + n]
                    removed = int(own.sum())
                    if removed:
                        words = [w for w, c in zip(words, own.tolist()) if not c]
                    kept = b" ".join(words)
                    out.append((real_id(i), n, removed, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
                    a += n
                yield record_batch(out, RESULT)

    return remove


def remove_repeated_windows(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, the kept words (kept)."""
    spark = docs.sparkSession
    blocks = block_table(docs, BLOCK)
    # one number, from one row per block
    raw = blocks.agg(F.sum("raw_bytes")).first()[0] or 0
    buckets = max(1, math.ceil(raw / BUCKET_BYTES))
    parts = min(buckets, 2 * shuffle_width(spark))
    # what comes back to a block is bounded by what it sent
    found = stream_by(blocks.mapInArrow(_seen(buckets), SEEN), "bucket", parts, _found, FOUND)
    found = found.groupBy("block").agg(F.collect_list(F.struct("bucket", "marks")).alias("found"))
    sent = blocks.join(found.hint("merge"), "block").mapInArrow(_send(buckets), SENT)
    verdicts = stage(stream_by(sent, "bucket", parts, _judge, VERDICTS), "window-verdicts")
    answers = verdicts.groupBy("block").agg(F.collect_list(F.struct("tags", "masks")).alias("verdicts"))
    return blocks.join(answers.hint("merge"), "block", "left").mapInArrow(_remove(keep_text), RESULT)
