"""Order-preserving packing of token streams into windows by dynamic programming.

Documents are range-partitioned by id, or by the columns given as their order, and stay in that order. A task tokenises its documents one
after the other and packs them in blocks of about ``BLOCK`` tokens: it chooses window cuts among
document ends, sentence ends and, inside long sentences, every ``STRIDE`` tokens, minimising padding
plus a penalty for the kind of cut. The best predecessor of a cut is the one with the smallest
``cost + position`` within reach of one window, which a monotone queue gives in constant time.
What follows a block's last cut starts the next block; only the end of a partition leaves a short
window, which is split at powers of two as those need no padding.

Memory of a task: one block of tokens and one document. A lost task is repeated alone.

Defined results: a null text is empty (its document is the end token alone); repeated ids are packed
next to each other unless another order is given; an empty table gives no piece; extra columns are ignored; a text of any length
spans as many windows as it needs. Sequence ids are unique and rise with the order of documents.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width, small_batches

WINDOW = 4096
END = 2
BLOCK = 64 * WINDOW
STRIDE = 32
#: Words in a line that is encoded at once.
LINE = 500
#: Penalties in tokens of padding for cutting at a sentence's end, and inside a sentence.
SENTENCE, TORN = 4, 24
#: Encoded words that a worker remembers; beyond it the half that most batches met stays.
CACHE = 500_000
#: A word that is one run of letters: ASCII in lower case, or of the block U+00C0 to U+00FF.
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: Of every byte: 0 blank, 1 lower-case letter, 2 ASCII symbol other than an apostrophe, 4 anything else.
KIND = np.array([0 if chr(b) in " \t\n\x0b\f\r" else 1 if 97 <= b <= 122 else 2 if 32 < b < 127 and not chr(b).isalnum() and b != 39 else 4 for b in range(256)], np.uint8)
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Words:
    """Token ids of words, encoded when first met and remembered.

    The tokenizer lowers case, drops white space, never merges across it, and splits letters from symbols.
    A text's ids are then those of its words, one after the other. Words are parted further where a letter
    and an ASCII symbol meet (but for apostrophes, which belong to contractions), and an ASCII letter is lowered
    where no combining mark may follow it, so that fewer are distinct. Texts with special tokens are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Of every id: whether its token ends in a full stop, question or exclamation mark; whether it ends a run of letters.
        self.marks, self.last = np.zeros(size, bool), np.zeros(size, bool)
        self.marks[[i for t, i in vocabulary.items() if t.removesuffix("</w>")[-1:] in (".", "!", "?")]] = True
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._forget([], np.empty(0, np.int64))

    def _forget(self, words: list[bytes], hits: np.ndarray) -> None:
        """Keeps the entries of ``words`` only."""
        old = [self._ids(w) for w in words]
        self.number = {w: k for k, w in enumerate(words)}
        self.hits = hits
        self.count = np.array([len(x) for x in old], np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.pool = np.concatenate(old) if old else np.empty(0, np.uint32)

    def _ids(self, word: bytes) -> np.ndarray:
        k = self.number[word]
        return self.pool[self.first[k] : self.first[k] + self.count[k]]

    def _add(self, words: list[bytes]) -> None:
        """Encodes new words: those that are one run of letters in long lines, the rest one by one."""
        plain, other = [], []
        for w in words:
            (plain if w.isalpha() or LETTERS.fullmatch(w) else other).append(w)
        lines = [b" ".join(plain[k : k + LINE]).decode() for k in range(0, len(plain), LINE)]
        ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        ends = np.flatnonzero(self.last[np.concatenate(ids)]) + 1 if ids else np.empty(0, np.int64)
        assert len(ends) == len(plain)
        more = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in other], add_special_tokens=False)]
        count = np.concatenate([np.diff(ends, prepend=0), np.array([len(x) for x in more], np.int64)])
        self.number.update(zip(chain(plain, other), range(len(self.number), len(self.number) + len(words))))
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.hits = np.concatenate([self.hits, np.zeros(len(count), np.int64)])
        self.pool = np.concatenate([self.pool, *ids, *more])

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """Entry of each word; new ones are added."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.number) > CACHE:
            best = np.sort(np.argsort(-self.hits, kind="stable")[: CACHE // 2])
            names = list(self.number)
            self._forget([names[k] for k in best.tolist()], self.hits[best] // 2)
        new = [w for w in distinct if w not in self.number]
        if new:
            self._add(new)
        entry = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        self.hits[entry] += 1
        return entry[coded.indices.to_numpy()]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Token ids of each text, with the end token."""
        whole = {}
        for k, t in enumerate(texts):
            low = t.lower()
            if any(x in low for x in self.special):
                whole[k] = np.array(self.tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)
        texts = [b"" if k in whole else t for k, t in enumerate(texts)]
        begins, words = split_words(texts)
        entry = self._numbers(words) if len(words) else np.empty(0, np.int64)
        count = self.count[entry]
        done = np.append(0, np.cumsum(count))
        stream = self.pool[np.repeat(self.first[entry] - done[:-1], count) + np.arange(done[-1])]
        # a text's words are those that begin before the next text does
        cuts = done[np.searchsorted(begins, np.cumsum([len(t) + 1 for t in texts]))].tolist()
        return [np.append(whole.get(k, stream[a:b]), np.uint32(END)) for k, (a, b) in enumerate(zip([0, *cuts], cuts))]


@lru_cache(maxsize=1)
def words_of(path: str) -> Words:
    """The worker's words, so that its next task needn't learn them anew."""
    return Words(path)


def split_words(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """Words of all texts and where each begins, if a blank closes every text; letters are lowered, and words
    parted, as ``Words`` says."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    follows = np.append(data[1:], np.uint8(32))
    # combining marks are not ASCII and don't start with byte C3
    upper = (data >= 65) & (data <= 90) & ((follows < 128) | (follows == 0xC3))
    data = data + (upper.view(np.uint8) << 5)
    kind = KIND[data]
    accent = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
    kind[accent] = kind[accent + 1] = 1
    before = np.append(np.uint8(0), kind[:-1])[: len(kind)]
    begin = (kind > 0) & ((before == 0) | (kind + before == 3))
    begins = np.flatnonzero(begin)
    ends = np.flatnonzero((kind > 0) & np.append(begin[1:] | (kind[1:] == 0), True)[: len(kind)]) + 1
    places = np.append(0, np.cumsum(ends - begins)).astype(np.int32)
    return begins, pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(places), pa.py_buffer(data[kind > 0])])


def cut_points(ends: np.ndarray, sentences: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places where a window may end, and the penalty of each. Both inputs are sorted."""
    places = np.unique(np.concatenate([[0], ends, sentences]))
    gaps = np.diff(places)
    long = np.flatnonzero(gaps > stride)
    torn = [np.arange(places[i] + stride, places[i + 1], stride) for i in long]
    all_places = np.unique(np.concatenate([places, *torn])) if torn else places
    penalty = np.full(len(all_places), TORN, np.int64)
    penalty[np.searchsorted(all_places, sentences)] = SENTENCE
    penalty[np.searchsorted(all_places, ends)] = 0
    penalty[0] = 0
    return all_places, penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Window ends with the least padding plus penalties; less than a window is left behind them,
    which costs nothing here: it goes on in the next block, or is the end.

    ``places`` start at 0 and leave no gap above ``window``.
    """
    at, fee = places.tolist(), penalty.tolist()
    n = len(at)
    cost, back = [0] * n, [0] * n
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # (cost + place, place, index), rising
    for i in range(1, n):
        here = at[i]
        while queue[0][1] < here - window:
            queue.popleft()
        head = queue[0]
        # padding is window - (here - place), so the smallest cost + place is best
        cost[i] = c = head[0] + window - here + fee[i]
        back[i] = head[2]
        key = c + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, here, i))
    near = range(int(np.searchsorted(places, at[-1] - window)), n)
    cuts, i = [], min(near, key=lambda i: (cost[i], -i))
    while i > 0:
        cuts.append(at[i])
        i = back[i]
    return cuts[::-1]


def tail_cuts(length: int, window: int = WINDOW) -> list[int]:
    """Ends of the windows for a last stretch under one window: powers of two, which need no padding."""
    out, done = [], 0
    for bit in reversed(range(window.bit_length())):
        if (length - done) >> bit:
            done += 1 << bit
            out.append(done)
    return out


class Block:
    """Documents that wait for their windows, with the places where they may be cut."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.docs: list[list] = []  # [doc_id, tokens of the document, start of what waits, ids that wait]
        self.size = 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append([doc_id, len(ids), 0, ids])
        self.size += len(ids)

    def cut(self, last: bool) -> Iterator[list[tuple]]:
        """Windows as lists of (doc_id, start, ids, doc_tokens, offset)."""
        ends = np.cumsum([len(d[3]) for d in self.docs])
        stream = np.concatenate([d[3] for d in self.docs])
        sentences = np.flatnonzero(self.marks[stream]) + 1
        cuts = best_cuts(*cut_points(ends, sentences))
        if last:
            begin = cuts[-1] if cuts else 0
            cuts += [begin + x for x in tail_cuts(len(stream) - begin)]
        k, place = 0, 0
        for cut in cuts:
            pieces, offset = [], 0
            while place < cut:
                doc_id, tokens, start, ids = self.docs[k]
                take = min(len(ids), cut - place)
                pieces.append((doc_id, start, ids[:take], tokens, offset))
                place += take
                offset += take
                if take == len(ids):
                    k += 1
                else:
                    self.docs[k] = [doc_id, tokens, start + take, ids[take:]]
            yield pieces
        self.docs = self.docs[k:]
        self.size = sum(len(d[3]) for d in self.docs)


def packer(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [x.split()[0] for x in PIECES.split(", ")]

    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, block, serial = None, None, 0
        for batch in batches:
            if words is None:
                words = words_of(path)
                block = Block(words.marks)
                serial = batch.column("part")[0].as_py() << 33 if batch.num_rows else 0
            rows: list[tuple] = []
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.encode(texts)):
                block.add(doc_id, ids)
                if block.size >= BLOCK:
                    for window in block.cut(False):
                        rows += [(d, s, len(i), zlib.crc32(i.tobytes()), n, serial, o) for d, s, i, n, o in window]
                        serial += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
        if block is not None and block.size:
            rows = []
            for window in block.cut(True):
                rows += [(d, s, len(i), zlib.crc32(i.tobytes()), n, serial, o) for d, s, i, n, o in window]
                serial += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return pack_partition


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def stored_order() -> list[Column]:
    """The order in which Spark wrote the rows of a table that is read from its Parquet files: by number of the
    part file, name of the file, and row."""
    name = F.col("_metadata.file_name")
    return [F.coalesce(F.try_to_number(F.regexp_extract(name, r"^part-(\d+)", 1), F.lit("9" * 18)), F.lit(0)).cast("long"), name, F.col("_metadata.row_index")]


def pack(docs: DataFrame, path: str | None = None, order: Sequence[Column] | None = None) -> DataFrame:
    """One row per piece of a document in a window. ``path``: a tokenizer file on every machine; ``order``: columns
    by which the documents follow each other, in place of doc_id."""
    spark = docs.sparkSession
    small_batches(spark, 4000)
    slim = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    if order is None:
        ordered = docs.select(*slim).repartitionByRange(shuffle_width(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    else:
        keys = [f"order{n}" for n in range(len(order))]
        ordered = docs.select(*slim, *[c.alias(k) for k, c in zip(keys, order)])
        ordered = ordered.repartitionByRange(shuffle_width(spark), *keys).sortWithinPartitions(*keys).drop(*keys)
    return ordered.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(packer(path or tokenizer_path()), PIECES)
