"""Web archive records: writing, and reading with segment reassembly (operator 2).

Writing: a response record carries an HTTP message whose body, the page, is in
chunked transfer framing.  A record longer than ``segment_bytes`` is cut: the
first part stays a response with segment number 1, the rest become
continuation records that name the first one's id, and the last of them states
the total length.  A page whose payload (of at least ``DEDUP_BYTES``) another
page with a smaller id also has becomes a revisit of that page's response.
Files are gzip-compressed and hold a bounded number of records.

Reading: a file is a task's stream of records; continuation records are grouped
by origin id, put in order of their segment numbers, checked against the
numbers 1..n and the stated total length, joined, and the chunked framing is
decoded.  A record that fails a check is kept with ``complete`` false and no
payload; so is a payload that differs from its stated digest.

Defined results: a null html is an empty payload; a null url is left out;
pages equal in id and payload are each a response when their id is the
payload's smallest; a null id sorts after all others; an empty table gives an
empty archive; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, chunks, cut, shared_path, table

DEDUP_BYTES = 100
SEGMENT_BYTES = 64 << 10
CHUNK = 16 << 10
RECORDS_PER_FILE = 2048
DATE = "2024-01-01T00:00:00Z"
_CRLF = b"\r\n"
_END = b"\r\n\r\n"


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for a response)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    p = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    long = p.where(F.octet_length("payload") >= DEDUP_BYTES)
    repeated = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = cut(repeated.select(F.col("digest").alias("__digest"), "first"), "repeated")
    j = p.join(repeated, F.col("digest") == F.col("__digest"), "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return j.select("page_id", "url", "payload", "digest", F.when(other, F.col("first")).alias("refers_to"))


def chunked(payload: bytes) -> bytes:
    parts = []
    for at in range(0, len(payload), CHUNK):
        piece = payload[at : at + CHUNK]
        parts += [b"%x" % len(piece), _CRLF, piece, _CRLF]
    return b"".join([*parts, b"0", _CRLF, _CRLF])


def unchunked(body: bytes) -> bytes:
    """Decode chunked transfer framing (extensions and trailers are skipped)."""
    out, at = [], 0
    while True:
        line = body.index(_CRLF, at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != _CRLF:
            raise ValueError("chunk without its end")
        out.append(body[at : at + size])
        at += size + 2


def _head(fields: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + _CRLF


def records_of(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object, segment_bytes: int) -> Iterator[bytes]:
    """The record of one page, or its segments, without the closing blank lines."""
    own = f"<urn:uuid:{uuid.uuid4()}>"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        kind, block = "response", http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    else:
        kind, block = "revisit", http + _CRLF
    fields = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~", errors="replace")))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-Id", str(refers_to))]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    if len(parts) > 1:
        fields.append(("WARC-Segment-Number", "1"))
    yield _head([*fields, ("Content-Length", str(len(parts[0])))]) + parts[0]
    for k, part in enumerate(parts[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(k))]
        if k == len(parts):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _head([*more, ("Content-Length", str(len(part)))]) + part


def write_archives(pages: DataFrame, folder: str, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) as .gz archives.
    A record's closing blank lines are the line separator of the text sink."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "payload"):
            rows = zip(*[c.to_pylist() for c in batch.columns], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([r for row in rows for r in records_of(*row, segment_bytes)], pa.binary())], ["record"])

    records = arrow_map(with_revisits(pages), build, "record binary")
    out = records.select(F.col("record").cast("string").alias("value")).write
    out.option("lineSep", _END.decode()).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(folder)


_RAW = "record_type string, record_id string, page_id string, url string, refers_to string, digest string, segment int, origin string, total long, block binary"


def _field(name: str, head: dict[str, str]) -> str | None:
    return head.get(name.lower())


def parse_stream(data: Iterator[bytes]) -> Iterator[tuple]:
    """Raw records of one uncompressed archive stream, in order."""
    buffer, ended = bytearray(), False

    def fill(n: int) -> bool:
        nonlocal ended
        while len(buffer) < n and not ended:
            more = next(data, None)
            ended = more is None
            buffer.extend(more or b"")
        return len(buffer) >= n

    while True:
        while fill(2) and buffer[:2] == _CRLF:
            del buffer[:2]
        if not buffer:
            return
        size = 4096
        while (at := buffer.find(_END)) < 0:
            if not fill(size):
                raise ValueError("archive ends inside a record's header")
            size *= 2
        lines = bytes(buffer[:at]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one should begin")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(head["content-length"])
        if not fill(at + 4 + length):
            raise ValueError("archive ends inside a record")
        block = bytes(buffer[at + 4 : at + 4 + length])
        del buffer[: at + 4 + length]
        number, total = _field("WARC-Segment-Number", head), _field("WARC-Segment-Total-Length", head)
        own = _field("WARC-Record-ID", head)
        origin = (_field("WARC-Segment-Origin-ID", head) or own) if number else None
        digest = (_field("WARC-Payload-Digest", head) or "").removeprefix("sha256:") or None
        yield (
            _field("WARC-Type", head), own, _field("X-Page-Id", head), _field("WARC-Target-URI", head), _field("X-Refers-To-Page-Id", head),
            digest, int(number) if number else None, origin, int(total) if total else None, block,
        )


def _gunzip(content: pa.Scalar) -> Iterator[bytes]:
    view, unzip = memoryview(content.as_buffer()), zlib.decompressobj(31)
    for at in range(0, len(view), 1 << 18):
        data = bytes(view[at : at + (1 << 18)])
        while data:
            yield unzip.decompress(data, 1 << 20)
            data = unzip.unconsumed_tail
            if unzip.eof:  # another gzip member follows
                data, unzip = unzip.unused_data, zlib.decompressobj(31)


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives below ``folder``, segments apart."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 6 + [pa.int32(), pa.string(), pa.int64(), pa.binary()]
        names = [x.split()[0] for x in _RAW.split(", ")]

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for row in parse_stream(_gunzip(content)):
                    rows.append(row)
                    held += len(row[-1])
                    if held > 2 << 20:
                        yield packed(rows)
                        rows, held = [], 0
                if rows:
                    yield packed(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).where(F.col("length") > 0).select("content")
    return arrow_map(files, parse, _RAW)


def _decode(parts: list[dict], total: int | None) -> bytes:
    """The payload of a record from its segments; ValueError if one is missing."""
    numbers = [p["segment"] for p in parts]
    block = b"".join(p["block"] for p in parts)
    if numbers != [None]:
        if numbers != list(range(1, len(parts) + 1)):
            raise ValueError("segments are missing or doubled")
        if total != len(block):
            raise ValueError("the segments' length is not the stated total")
    head, _, body = block.partition(_END)
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, url, record_type, refers_to, digest (as stated), payload (null
    for a revisit or an incomplete record), complete; one row per page record."""
    raw = raw_records(spark, folder)
    part = F.struct("segment", "block")
    fields = ["page_id", "url", "record_type", "refers_to", "digest"]
    whole = raw.where("segment IS NULL").select(*fields, F.lit(None).cast("long").alias("total"), F.array(part).alias("parts"))
    first = [F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in fields]
    # a group is one page's segments
    cut_up = raw.where("segment IS NOT NULL").groupBy("origin").agg(*first, F.max("total").alias("total"), F.sort_array(F.collect_list(part)).alias("parts")).drop("origin")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                piece = batch.slice(at, 64)
                payloads, complete = [], []
                for kind, digest, total, parts in zip(*[piece.column(c).to_pylist() for c in (2, 4, 5, 6)], strict=True):
                    payload, ok = None, kind == "revisit"
                    if kind == "response":
                        try:
                            payload = _decode(parts, total)
                            ok = digest is None or hashlib.sha256(payload).hexdigest() == digest
                        except ValueError:
                            ok = False
                    payloads.append(payload if ok else None)
                    complete.append(ok)
                yield pa.RecordBatch.from_arrays([*piece.columns[:5], pa.array(payloads, pa.binary()), pa.array(complete)], [*fields, "payload", "complete"])

    schema = ", ".join(f"{c} string" for c in fields) + ", payload binary, complete boolean"
    return arrow_map(whole.unionByName(cut_up), decode, schema)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = shared_path(spark, "warc")
    write_archives(pages, folder)
    kind = pages.schema["page_id"].dataType
    payload = F.col("payload")
    digest = F.when(F.col("record_type") == "response", F.sha2(payload, 256)).otherwise(F.col("digest"))
    read = read_archives(spark, folder).select(
        F.col("page_id").cast(kind).alias("page_id"), F.octet_length(payload).cast("long").alias("bytes"), digest.alias("payload_digest"), "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )
    read = cut(read, "records")
    # a revisit's payload is its response's
    stored = read.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("__digest")).agg(F.max("bytes").alias("__bytes"))
    revisits = read.where("record_type = 'revisit'").join(stored, F.col("payload_digest") == F.col("__digest"), "left").withColumn("bytes", F.col("__bytes"))
    out = ["page_id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"]
    return read.where("record_type = 'response'").select(*out).unionByName(revisits.select(*out))


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
