"""WARC archives: writing segmented, chunked records, and reassembling them.

Writing: a page is an HTTP response with its payload in chunked transfer framing. A response block
longer than ``SEGMENT`` bytes is split into segments: the first record carries the headers, the
others are ``continuation`` records that name its id (``WARC-Segment-Origin-ID``), their
``WARC-Segment-Number`` and, on the last, ``WARC-Segment-Total-Length``. Equal payloads of at least
``REVISIT`` bytes are stored once, under the largest page id; the others become ``revisit`` records.
Every record is a gzip member of its own, so that readers can seek, and a file holds at most ``RECORDS_PER_FILE`` of
them, each of one segment at most. Spark's own text writer fills the folder, so any store that Spark reaches will do: a
member's last byte is the high byte of its length, 0 for any segment, which the writer sets as its line separator.

Reading: archives, of one or many gzip members or none, are inflated piece by piece and parsed record by record by their lengths. Segments are grouped by origin
(a group is one record), put in order of their numbers, checked against the total length, freed of
the chunk framing, and checked against the digest in the header. Revisits are resolved against
their response by a join.

Defined results: a null html is an empty payload; repeated page ids are kept as separate records
(record ids carry task and number); all rows with the largest id of a group of equal payloads are
responses; a null page_id revisits like others; an empty table gives no archive
and no row; extra columns are ignored. A damaged record (missing segment, wrong length, broken
framing or digest) raises unless ``strict`` is off, which returns it with ``intact`` false.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, shuffle_width, small_batches, stage

SEGMENT = 32 * 1024
CHUNK = 4 * 1024
REVISIT = 1000
#: Records in an archive file, at most: with segments of 32 KB under 140 MB.
RECORDS_PER_FILE = 4096
PIECE = 64 * 1024
VERSION = b"WARC/1.1\r\n"
DATE = "2024-01-01T00:00:00Z"
SEGMENTS = "origin string, page_id long, number long, kind string, digest string, refers long, total long, block binary, payload_bytes long, found_digest string, intact boolean"
PAYLOADS = "origin string, page_id long, kind string, digest string, refers long, payload_bytes long, found_digest string, intact boolean, payload binary"


def frame(payload: bytes, chunk: int = CHUNK) -> bytes:
    """Chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in (payload[i : i + chunk] for i in range(0, len(payload), chunk))]
    return b"".join(parts) + b"0\r\n\r\n"


def unframe(body: bytes) -> bytes:
    """Payload of a chunked body; raises ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        out.append(body[at : at + size])
        at += size + 2


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return VERSION + head.encode() + b"\r\n" + block


def page_records(record_id: str, page_id: int, url: str, payload: bytes, digest: str, refers_to: int | None, segment: int = SEGMENT) -> list[bytes]:
    """A page's records without the two line ends that close each."""
    url = re.sub(r"[\x00-\x20]", "%20", url or "") or "about:blank"
    fields = [("WARC-Record-ID", f"<urn:page:{record_id}>"), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Page-ID", str(page_id))]
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        fields += [("WARC-Type", "revisit"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Refers-To-Page-ID", str(refers_to))]
        return [record(fields, status + b"\r\n")]
    block = status + b"Transfer-Encoding: chunked\r\n\r\n" + frame(payload)
    pieces = [block[i : i + segment] for i in range(0, len(block), segment)]
    fields += [("WARC-Type", "response"), ("Content-Type", "application/http; msgtype=response")]
    if len(pieces) == 1:
        return [record(fields, block)]
    out = [record([*fields, ("WARC-Segment-Number", "1")], pieces[0])]
    for k, piece in enumerate(pieces[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{record_id}:{k}>"), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Segment-Origin-ID", f"<urn:page:{record_id}>"), ("WARC-Segment-Number", str(k))]
        out.append(record(more + [("WARC-Segment-Total-Length", str(len(block)))] * (k == len(pieces)), piece))
    return out


def member(record: bytes) -> bytes:
    """A closed record as a gzip member without its last byte, which is 0."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(record + b"\r\n\r\n") + packer.flush()
    assert out[-1] == 0, "records of 16 MB or more need segments"
    return out[:-1]


def inflate(data: bytes, piece: int = PIECE) -> Iterator[bytes]:
    """The content of an archive in pieces: gzip members one after the other, or plain bytes."""
    packed = data[:2] == b"\x1f\x8b"
    unpacker = zlib.decompressobj(31)
    for at in range(0, len(data), piece):
        rest = data[at : at + piece]
        while rest and packed:
            if unpacker.eof:
                unpacker = zlib.decompressobj(31)
            yield unpacker.decompress(rest)
            rest = unpacker.unused_data
        if rest:
            yield rest
    if packed and not unpacker.eof:
        raise ValueError("archive ends inside a gzip member")


def parse_records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an archive: fields by lower-case name, and the block. Holds one record and one piece."""
    held, need = bytearray(), 0
    head: tuple[dict[str, str], int, int] | None = None  # fields, begin and end of the block
    for piece in pieces:
        held += piece
        while len(held) > need:
            if head is None:
                end = held.find(b"\r\n\r\n")
                if not held.startswith(VERSION[: len(held)]):
                    raise ValueError("no record where one should start")
                if end < 0:
                    break
                fields = {}
                for line in held[len(VERSION) : end].decode("utf-8", "replace").split("\r\n"):
                    k, _, v = line.partition(":")
                    fields[k.strip().lower()] = v.strip()
                stop = end + 4 + int(fields["content-length"])
                head, need = (fields, end + 4, stop), stop + 3
                continue
            fields, begin, stop = head
            if held[stop : stop + 4] != b"\r\n\r\n":
                raise ValueError("a record doesn't end where it says")
            yield fields, bytes(held[begin:stop])
            del held[: stop + 4]
            head, need = None, 0
    if held:
        raise ValueError("archive ends inside a record")


def with_digests(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, and the page that each one revisits (refers_to).

    The pages are read twice: once for the digests of repeated payloads, once for the payloads.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha1("payload"))
    long = F.octet_length("payload") >= REVISIT
    groups = rows.where(long).groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n")
    other = long & (F.col("response") != F.coalesce("page_id", F.lit(-1)))
    return rows.join(groups, "digest", "left").withColumn("refers_to", F.when(other, F.col("response"))).drop("response")


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        out, held = [], 0
        for r in batch.to_pylist():
            n += 1
            for x in page_records(f"{r['page_id']}.{part}.{n}", r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"]):
                out.append(member(x))
                held += len(out[-1])
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write_warc(pages: DataFrame, path: str) -> None:
    """Writes the archives of ``pages`` to the folder ``path``."""
    small_batches(pages.sparkSession, 500)
    members = with_digests(pages).mapInArrow(_write, "value binary").select(F.col("value").cast("string").alias("value"))
    members.write.option("lineSep", "\0").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _whole(x: str | None) -> int | None:
    return int(x) if x not in (None, "None") else None


def _batch(rows: list[tuple], names: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in names.split(", "))])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _parser(keep_payload: bool):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for f, block in parse_records(inflate(content.as_py())):
                    s = {"origin": f.get("warc-segment-origin-id") or f["warc-record-id"], "page_id": _whole(f.get("page-id")), "number": _whole(f.get("warc-segment-number")) or 0, "kind": f["warc-type"], "digest": f.get("warc-payload-digest", "").removeprefix("sha1:") or None, "refers": _whole(f.get("refers-to-page-id")), "total": _whole(f.get("warc-segment-total-length")), "block": block}
                    found = (None, None, None)
                    if not s["number"]:  # whole records are decoded here; only segments travel
                        payload, intact = join_segments([s])
                        found = (len(payload), hashlib.sha1(payload).hexdigest(), intact)
                        s["block"] = payload if keep_payload else None
                    rows.append((*s.values(), *found))
                    size += len(s["block"] or b"")
                    if size > 8 << 20 or len(rows) >= 5000:
                        yield _batch(rows, SEGMENTS)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, SEGMENTS)

    return parse


def join_segments(segments: list[dict]) -> tuple[bytes, bool]:
    """Payload of a record from its segments in order, and whether all checks hold."""
    first, last = segments[0], segments[-1]
    block = b"".join(s["block"] for s in segments)
    intact = first["kind"] != "continuation"
    if len(segments) > 1 or first["number"]:
        intact &= [s["number"] for s in segments] == list(range(1, len(segments) + 1)) and last["total"] == len(block)
    head, _, body = block.partition(b"\r\n\r\n")
    if first["kind"] != "response":
        return b"", bool(intact)
    try:
        payload = unframe(body) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head) else body
    except ValueError:
        return b"", False
    return payload, bool(intact and (not first["digest"] or hashlib.sha1(payload).hexdigest() == first["digest"]))


def _reassemble(keep_payload: bool):
    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(segments: list[dict]) -> tuple:
            f = segments[0]
            if f["intact"] is not None:
                return f["origin"], f["page_id"], f["kind"], f["digest"], f["refers"], f["payload_bytes"], f["found_digest"], f["intact"] and len(segments) == 1, f["block"]
            payload, intact = join_segments(segments)
            return f["origin"], f["page_id"], f["kind"], f["digest"], f["refers"], len(payload), hashlib.sha1(payload).hexdigest(), intact, payload if keep_payload else None

        waiting: list[dict] = []  # segments of one record: rows come sorted by origin and number
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if waiting and waiting[0]["origin"] != r["origin"]:
                    rows.append(done(waiting))
                    waiting = []
                waiting.append(r)
            if rows:
                yield _batch(rows, PAYLOADS)
        if waiting:
            yield _batch([done(waiting)], PAYLOADS)

    return reassemble


def read_warc(spark: SparkSession, path: str, keep_payload: bool = True, strict: bool = True) -> DataFrame:
    """One row per record of the archives in ``path``: origin (its id), page_id, kind, payload_bytes,
    payload_digest, refers_to (a revisit's page), intact, payload (null for revisits)."""
    small_batches(spark, 500)
    segments = spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parser(keep_payload), SEGMENTS)
    dealt = segments.repartition(shuffle_width(spark), "origin").sortWithinPartitions("origin", "number")
    records = stage(dealt.mapInArrow(_reassemble(keep_payload), PAYLOADS), "warc-records")
    if strict:
        records = records.withColumn("intact", F.when(F.col("intact"), True).otherwise(F.raise_error(F.concat(F.lit("damaged record "), F.col("origin"))).cast("boolean")))
    # One row per stored payload and page: repeats of a row were stored each.
    targets = records.where("kind = 'response'").groupBy(F.col("page_id").alias("refers"), F.col("found_digest").alias("digest")).agg(F.max("payload_bytes").alias("full_bytes"))
    revisits = records.where("kind = 'revisit'").drop("payload_bytes").join(targets, ["refers", "digest"], "left")
    revisits = revisits.select("origin", "page_id", "kind", F.col("full_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("refers").alias("refers_to"), (F.col("intact") & F.col("full_bytes").isNotNull()).alias("intact"), F.lit(None).cast("binary").alias("payload"))
    rest = records.where("kind != 'revisit'").select("origin", "page_id", "kind", "payload_bytes", F.col("found_digest").alias("payload_digest"), F.lit(None).cast("long").alias("refers_to"), "intact", "payload")
    return rest.unionByName(revisits)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads these back."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, path)
    return read_warc(spark, path, keep_payload=False)
