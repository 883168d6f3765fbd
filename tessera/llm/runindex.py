"""Substring deduplication with a run-length index.

Every byte is removed that a ``LENGTH``-byte string covers which also starts anywhere else. Texts are
cut into strings of consecutive windows that share a minimiser (the smallest hash of the window's
``ANCHOR``-byte substrings), so equal windows always come in strings of one minimiser. Minimisers
found once in the whole corpus can't belong to a repeated window; only the strings of the others
travel, each distinct string of a block once with how often it occurred.

A group of minimisers gets a run-length index over its distinct strings: a suffix array (prefix
doubling on packed integer keys), its Burrows-Wheeler transform in runs, and samples at the run ends
only: text position and longest common prefix with the neighbour beyond the end. Within a run the
next text position's common prefix is one byte shorter, so the samples give the matching statistics of all
strings against all others, streamed along the text: the value of the last sample less the distance
to it. Windows whose statistic reaches ``LENGTH``, and all windows of a string that occurs more
than once, are repeated. Blocks get a list of repeated stretches per string and cut their texts.

Defined results: a null text is empty; ids play no part (a repeated row repeats all its windows);
texts under ``LENGTH`` bytes stay as they are; an empty table gives an empty table; extra columns are
ignored. ``kept`` is binary: cuts may fall inside a character.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_table, by_key, mixed, open_block, real_id, record_batch, settle, shuffle_width, sliding_min, stage, stream_by

LENGTH = 400
ANCHOR = 32
LONGEST = 1024  # windows in a string
#: Text bytes behind a bucket of minimisers.
BUCKET_BYTES = 4 << 20
#: Symbols in one index: below 2^20, so that two ranks and a place fit one integer. A group of strings
#: of one minimiser may exceed it.
INDEX = 900_000
ANCHORS = "bucket long, block long, hashes binary, counts binary"
FOUND = "block long, hashes binary"
SENT = "bucket long, block long, keys binary, tags binary, times binary, lengths binary, strings binary"
VERDICTS = "block long, tags binary, starts binary, ends binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
PRIME = np.uint64(0x9E3779B97F4A7C15)


def anchor_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the ``ANCHOR`` bytes from each position, by doubling."""
    h, step, factor = text.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while step < ANCHOR:
        h = h[:-step] * np.uint64(factor) + (h[step:] ^ (h[step:] >> np.uint64(29)))
        factor = factor * factor % (1 << 64) | 1
        step *= 2
    return mixed(h)


def window_runs(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one text: start, windows and minimiser of each string, and the hashes at all places that are
    the minimum of some window (a minimiser that stands twice counts twice)."""
    h = anchor_hashes(text)
    width = LENGTH - ANCHOR + 1
    least = sliding_min(h, width)
    new = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    size = np.diff(np.append(new, len(least)))
    if (size > LONGEST).any():
        more = -(-size // LONGEST)
        step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
        new, last = np.repeat(new, more) + step * LONGEST, np.repeat(new + size, more)
        size = np.minimum(LONGEST, last - new)
    # the largest of the minima of the windows over a place is its own hash exactly where it is one of them
    most = ~sliding_min(~np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]), width)
    return new, size, least[new], h[most == h]


class Runs:
    """The strings of a block; the same for the same block whenever it is made."""

    def __init__(self, row: dict):
        self.ids, self.ends, self.data = open_block(row["ids"], row["lengths"], row["texts"])
        whole = np.frombuffer(self.data, np.uint8)
        parts, begin = [], 0
        for end in self.ends.tolist():
            if end - begin >= LENGTH:
                s, n, k, a = window_runs(whole[begin:end])
                parts.append((s + begin, n, k, a))
            begin = end
        pick = lambda i, kind: np.concatenate([p[i] for p in parts]) if parts else np.empty(0, kind)
        self.starts, self.windows, self.keys, self.anchors = pick(0, np.int64), pick(1, np.int64), pick(2, np.uint64), pick(3, np.uint64)


def _anchors(buckets: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = np.unique(Runs(row).anchors, return_counts=True)
                goal = (hashes % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(goal, kind="stable")
                cuts = np.flatnonzero(np.diff(goal[order], prepend=-1)).tolist() + [len(order)]
                rows = [(int(goal[order[a]]), row["block"], hashes[order[a:b]].tobytes(), np.minimum(counts[order[a:b]], 2).astype(np.uint8).tobytes()) for a, b in zip(cuts, cuts[1:])]
                if rows:
                    yield record_batch(rows, ANCHORS)

    return anchors


def repeated_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers each block with those of its minimisers that stand in two places or more."""
    for _, rows in by_key(batches, "bucket"):
        hashes = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
        counts = [np.frombuffer(r["counts"], np.uint8) for r in rows]
        values, place = np.unique(np.concatenate(hashes), return_inverse=True)
        often = np.bincount(place, weights=np.concatenate(counts), minlength=len(values))[place] > 1
        out, k = [], 0
        for r, h in zip(rows, hashes):
            hit = often[k : k + len(h)]
            k += len(h)
            if hit.any():
                out.append((r["block"], h[hit].tobytes()))
        if out:
            yield record_batch(out, FOUND)


def _strings(row: dict) -> tuple[Runs, np.ndarray, list[bytes], np.ndarray]:
    """The block's runs, those with repeated minimisers, their strings, and for each the first equal one."""
    r = Runs(row)
    wanted = np.concatenate([np.frombuffer(x, np.uint64) for x in row["found"]]) if row["found"] else np.empty(0, np.uint64)
    chosen = np.flatnonzero(np.isin(r.keys, wanted))
    strings = [r.data[a:b] for a, b in zip(r.starts[chosen].tolist(), (r.starts[chosen] + r.windows[chosen] + LENGTH - 1).tolist())]
    seen: dict[bytes, int] = {}
    first = np.fromiter((seen.setdefault(s, k) for k, s in enumerate(strings)), np.int64, len(strings))
    return r, chosen, strings, first


def _send(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                r, chosen, strings, first = _strings(row)
                if not strings:
                    continue
                times = np.bincount(first, minlength=len(strings))
                own = np.flatnonzero(times)
                goal = (r.keys[chosen[own]] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(goal, kind="stable")
                cuts = np.flatnonzero(np.diff(goal[order], prepend=-1)).tolist() + [len(order)]
                rows = []
                for a, b in zip(cuts, cuts[1:]):
                    k = own[order[a:b]]
                    own_strings = [strings[i] for i in k.tolist()]
                    rows.append((int(goal[order[a]]), row["block"], r.keys[chosen[k]].tobytes(), k.astype(np.uint32).tobytes(), np.minimum(times[k], 2).astype(np.uint8).tobytes(), np.array([len(s) for s in own_strings], np.uint32).tobytes(), zstandard.compress(b"".join(own_strings), 3)))
                yield record_batch(rows, SENT)

    return send


class RunLengthIndex:
    """Burrows-Wheeler transform of distinct strings in runs, sampled at the run ends."""

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings], np.int64)
        self.ends = np.cumsum(lengths + 1) - 1  # places of the separators
        self.text = np.zeros(int(lengths.sum()) + len(strings), np.int64)
        body = np.ones(len(self.text), bool)
        body[self.ends] = False
        self.text[body] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
        self._sort()
        n = len(self.text)
        before = self.text[self.suffixes - 1]  # the first text's predecessor is the last separator
        ends = np.flatnonzero(before == 0)
        before[ends] = -1 - np.arange(len(ends))  # separators differ from each other
        #: Rows at which a run of the transform starts; the row before ends a run.
        self.heads = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        inner = self.heads[1:]
        common = self._common_prefix(self.suffixes[inner - 1], self.suffixes[inner])
        #: Samples: text place, and common prefix with the neighbour across the run's end.
        self.down = (np.append(self.suffixes[inner - 1], self.suffixes[-1]), np.append(common, 0))
        self.up = (np.append(self.suffixes[0], self.suffixes[inner]), np.append(0, common))
        self.size = n
        self.levels = None

    def _sort(self) -> None:
        """Suffix array by prefix doubling; separators end a suffix and count as different."""
        n = len(self.text)
        bits = max(1, int(n).bit_length())
        place = np.arange(n, dtype=np.int64)
        key = self.text.copy()
        for k in range(1, 4):  # four symbols of nine bits, none of them beyond a separator
            key = key << 9
            key[:-k] |= self.text[k:]
        stop = self.ends[np.searchsorted(self.ends, place)] - place  # symbols before the separator
        for k in range(4):
            cut = stop == k
            key[cut] = key[cut] >> 9 * (4 - k) << 9 * (4 - k)
        short = stop < 4
        depth = 4
        self.levels: list[tuple[int, np.ndarray]] = []
        rank, order, groups = self._rank(key, bits, place, 36, short)
        while True:
            self.levels.append((depth, rank.astype(np.int32)))
            if groups == n:
                break
            second = np.zeros(n, np.int64)
            second[: n - depth] = rank[depth:] + 1
            ended = stop < depth
            second[ended] = 0
            rank, order, groups = self._rank(rank << bits + 1 | second, bits, place, 2 * bits + 1, None)
            depth *= 2
        self.suffixes = order

    @staticmethod
    def _rank(key: np.ndarray, bits: int, place: np.ndarray, width: int, unique: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Rank of each suffix (the rows with smaller keys), the order, and the number of ranks. Keys marked unique differ from all."""
        n = len(key)
        if width + bits <= 63:  # the place rides along: a plain sort
            packed = np.sort(key << bits | place)
            order = packed & ((1 << bits) - 1)
            packed >>= bits
        else:
            order = np.argsort(key, kind="stable")
            packed = key[order]
        new = np.append(True, packed[1:] != packed[:-1])
        if unique is not None:
            new |= unique[order]
            new[1:] |= unique[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        return rank, order, int(np.count_nonzero(new))

    def _common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefixes of pairs of suffixes, from the ranks at doubling depths."""
        done = np.zeros(len(a), np.int64)
        n = len(self.text)
        for depth, rank in reversed(self.levels):
            i, j = np.minimum(a + done, n - 1), np.minimum(b + done, n - 1)
            done += depth * (rank[i] == rank[j])
        for _ in range(3):
            i, j = np.minimum(a + done, n - 1), np.minimum(b + done, n - 1)
            done += (self.text[i] == self.text[j]) & (self.text[i] > 0)
        return done

    def matching_statistics(self) -> np.ndarray:
        """For each text place the length of the longest match that starts there and elsewhere too."""
        best = np.zeros(self.size, np.int64)
        for places, common in (self.up, self.down):
            # a sample's value falls by one with every byte until the next sample
            reach = np.full(self.size, -1, np.int64)
            reach[places] = places
            last = np.maximum.accumulate(reach)
            value = np.zeros(self.size, np.int64)
            value[places] = common
            known = last >= 0
            at = np.flatnonzero(known)
            best[at] = np.maximum(best[at], value[last[at]] - (at - last[at]))
        return best


def repeated_windows(strings: list[bytes], times: np.ndarray) -> list[np.ndarray]:
    """For each distinct string, which of its windows are repeated in it, in the others, or by its copies."""
    index = RunLengthIndex(strings)
    hit = index.matching_statistics() >= LENGTH
    out, begin = [], 0
    for s, n in zip(strings, times.tolist()):
        count = len(s) - LENGTH + 1
        out.append(np.ones(count, bool) if n > 1 else hit[begin : begin + count])
        begin += len(s) + 1
    return out


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in by_key(batches, "bucket"):
        distinct: dict[bytes, int] = {}
        keys: list[int] = []
        times: list[int] = []
        places: list[list[int]] = []  # of each row's strings
        for r in rows:
            data, at, own = zstandard.decompress(r["strings"]), 0, []
            for n, t, key in zip(np.frombuffer(r["lengths"], np.uint32).tolist(), r["times"], np.frombuffer(r["keys"], np.uint64).tolist()):
                k = distinct.setdefault(data[at : at + n], len(distinct))
                at += n
                if k == len(keys):
                    keys.append(key)
                    times.append(0)
                times[k] += t
                own.append(k)
            places.append(own)
        strings = list(distinct)
        starts, ends = [None] * len(strings), [None] * len(strings)
        batch: list[int] = []
        size = 0
        by_minimiser = sorted(range(len(strings)), key=keys.__getitem__)
        for x, k in enumerate(by_minimiser):
            batch.append(k)
            size += len(strings[k]) + 1
            last = x + 1 == len(by_minimiser)
            if last or size >= INDEX - 64 * LENGTH and keys[by_minimiser[x + 1]] != keys[k]:
                for i, hit in zip(batch, repeated_windows([strings[i] for i in batch], np.array([times[i] for i in batch]))):
                    edges = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
                    starts[i], ends[i] = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                batch, size = [], 0
        out = []
        for r, own in zip(rows, places):
            counts = np.array([len(starts[k]) for k in own])
            if counts.any():
                tags = np.repeat(np.frombuffer(r["tags"], np.uint32), counts)
                out.append((r["block"], tags.tobytes(), np.concatenate([starts[k] for k in own]).astype(np.uint16).tobytes(), np.concatenate([ends[k] for k in own]).astype(np.uint16).tobytes()))
        if out:
            yield record_batch(out, VERDICTS)


def _cut(keep_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                r, chosen, strings, first = _strings(row)
                edge = np.zeros(len(r.data) + 1, np.int32)
                if row["verdicts"]:
                    tags = np.concatenate([np.frombuffer(v["tags"], np.uint32) for v in row["verdicts"]]).astype(np.int64)
                    starts = np.concatenate([np.frombuffer(v["starts"], np.uint16) for v in row["verdicts"]]).astype(np.int64)
                    ends = np.concatenate([np.frombuffer(v["ends"], np.uint16) for v in row["verdicts"]]).astype(np.int64)
                    order = np.argsort(tags, kind="stable")
                    tags, starts, ends = tags[order], starts[order], ends[order]
                    # every string takes the verdicts of the first equal one
                    a, b = np.searchsorted(tags, first), np.searchsorted(tags, first, "right")
                    many = b - a
                    pick = np.repeat(a - (np.cumsum(many) - many), many) + np.arange(many.sum())
                    base = np.repeat(r.starts[chosen], many)
                    np.add.at(edge, base + starts[pick], 1)
                    np.add.at(edge, base + ends[pick] + LENGTH - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                out, begin = [], 0
                whole = np.frombuffer(r.data, np.uint8)
                for i, end in zip(r.ids.tolist(), r.ends.tolist()):
                    own = gone[begin:end]
                    removed = int(np.count_nonzero(own))
                    kept = whole[begin:end][~own].tobytes() if removed else r.data[begin:end]
                    spans = int(np.count_nonzero(own[1:] & ~own[:-1]) + own[0]) if removed else 0
                    out.append((real_id(i), end - begin, removed, spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
                    begin = end
                yield record_batch(out, RESULT)

    return cut


def bucket_count(blocks: DataFrame) -> int:
    """From one number, summed over a row per block."""
    return max(1, math.ceil((blocks.agg(F.sum("raw_bytes")).first()[0] or 0) / BUCKET_BYTES))


def _marked_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of documents, each with those of its minimisers that stand in two places or more (found)."""
    blocks = block_table(docs)
    buckets = bucket_count(blocks)
    found = stream_by(blocks.mapInArrow(_anchors(buckets), ANCHORS), "bucket", min(buckets, shuffle_width(docs.sparkSession)), repeated_hashes, FOUND)
    found = found.groupBy("block").agg(F.collect_list("hashes").alias("found"))  # bounded by what the block sent
    return blocks.join(found.hint("merge"), "block", "left")


def remove_repeated_bytes(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes (kept)."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    marked = settle(spark, lambda: _marked_blocks(docs), "marked-blocks")
    buckets = bucket_count(marked)
    sent = marked.repartition(width, "block").mapInArrow(_send(buckets), SENT)
    verdicts = stage(stream_by(sent, "bucket", min(buckets, 4 * width), _judge, VERDICTS), "byte-verdicts")
    answers = verdicts.groupBy("block").agg(F.collect_list(F.struct("tags", "starts", "ends")).alias("verdicts"))
    return marked.join(answers.hint("merge"), "block", "left").mapInArrow(_cut(keep_text), RESULT)
