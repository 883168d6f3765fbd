"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of characters other than these.
BLANKS = "\\x20\\x09-\\x0D"
WORD = f"[^{BLANKS}]+"

#: Spark's setting that removes a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Largest table, in rows, that ``attach`` broadcasts.
BROADCAST_ROWS = 50_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share. Where it is unset, a local master uses a
    folder of this process, as in tests; a cluster gets an error, as executors couldn't see that folder."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", folder)
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder.rstrip("/")


#: Paths staged inside the innermost ``settle``.
_staged: list[list[str]] = []


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Writes a table to the shared folder and reads it again: later steps neither repeat the
    work nor depend on the executors that did it. Shuffle files of the write go with its end."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    if _staged:
        _staged[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def settle(spark: SparkSession, build: Callable[[], DataFrame], tag: str) -> DataFrame:
    """Stages what ``build`` returns, then deletes the tables that it staged on its way."""
    _staged.append([])
    try:
        out = build()
        inner = _staged[-1]
    finally:
        _staged.pop()
    out = stage(out, tag)
    _delete(spark, inner)
    return out


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bounds Arrow batches of whole texts, so that a Python worker holds a few MB of them."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def attach(rows: DataFrame, table: DataFrame, keys: list[str], salts: int = 16) -> DataFrame:
    """Left join of a large table to one row per key (null-safe on the keys).

    The key table is broadcast only after its rows have been counted; beyond ``BROADCAST_ROWS``
    it is repeated ``salts`` times and the rows of a key are dealt over the copies, so that a key
    with a third of all rows doesn't end in one task. ``table`` should be staged: it is counted.
    """
    own = {k: fresh(rows, f"key_{k}") for k in keys}
    right = table.select(*[F.col(k).alias(own[k]) for k in keys], *[c for c in table.columns if c not in keys])
    on = [rows[k].eqNullSafe(right[own[k]]) for k in keys]
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(right), on, "left").drop(*own.values())
    salt, deal = fresh(rows, "salt"), fresh(rows, "deal")
    right = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    left = rows.withColumn(deal, F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(salts)).cast("int"))
    on = [left[k].eqNullSafe(right[own[k]]) for k in keys] + [left[deal] == right[salt]]
    return left.join(right, on, "left").drop(deal, salt, *own.values())


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have yet, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Text bytes in a block of documents.
BLOCK_BYTES = 8 << 20
BLOCKS = "block long, ids binary, lengths binary, texts binary, raw_bytes long"
NULL_ID = -(1 << 63)  # stands for a null doc_id inside blocks: before all others


def _to_blocks(size: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        texts: list[bytes] = []
        held = 0

        def block() -> pa.RecordBatch:
            order = sorted(range(len(ids)), key=ids.__getitem__)
            data = b"".join(texts[i] for i in order)
            row = [part << 33 | serial, np.array([ids[i] for i in order], np.int64).tobytes(), np.array([len(texts[i]) for i in order], np.int64).tobytes(), zstandard.compress(data, 3), len(data)]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], [x.split()[0] for x in BLOCKS.split(", ")])

        for batch in batches:
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                ids.append(NULL_ID if i is None else i)
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


def block_table(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """Documents packed into compressed blocks of about ``size`` text bytes, by doc_id in each, and
    written to the shared folder: later stages exchange verdicts with whole blocks by their id."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stage(slim.mapInArrow(_to_blocks(size), BLOCKS), "blocks")


#: Which bytes are blanks.
BLANK_BYTES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_array(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and the words of all texts in order; ``lower`` turns A-Z into a-z."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    if lower:
        data = data + (((data >= 65) & (data <= 90)).view(np.uint8) << 5)
    blank = BLANK_BYTES[data]
    begins = np.flatnonzero(~blank & np.append(True, blank[:-1])[: len(data)])
    ends = np.flatnonzero(blank & np.append(False, ~blank[:-1])[: len(data)])
    places = np.append(0, np.cumsum(ends - begins)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(places), pa.py_buffer(data[~blank])])
    return np.diff(np.searchsorted(begins, np.cumsum([len(t) + 1 for t in texts])), prepend=0), words


def open_block(ids: bytes, lengths: bytes, texts: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Document ids, where each text ends, and the texts one after the other."""
    return np.frombuffer(ids, np.int64), np.cumsum(np.frombuffer(lengths, np.int64)), zstandard.decompress(texts)


def real_id(i: int) -> int | None:
    return None if i == NULL_ID else i


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    s = 1
    while s * 2 <= width:
        x = np.minimum(x[:-s], x[s:])
        s *= 2
    rest = width - s
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Runs of rows of equal key, from batches that come sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0][key] != row[key]:
                yield held[0][key], held
                held = []
            held.append(row)
    if held:
        yield held[0][key], held


def record_batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    names, types = zip(*(x.split() for x in fields.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows) if rows else [[]] * len(names), types)], list(names))


def stream_by(df: DataFrame, key: str, parts: int, work, fields: str) -> DataFrame:
    """Deals rows by a key and runs ``work(batches)`` over them, sorted by the key."""
    return df.repartition(parts, key).sortWithinPartitions(key).mapInArrow(work, fields)
