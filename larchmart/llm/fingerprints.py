"""Document fingerprints by one-permutation MinHash (operator 6).

Every five-word shingle is hashed once; the hash's high bits choose one of 256
bins and the bin keeps its smallest remainder.  An empty bin takes the value of
a filled one by optimal densification: a fixed hash of (bin, attempt) names a
bin, and the first filled one named is copied, so that equal bins stay equal in
any two documents.  The low 8 bits of every bin are stored; the share of equal
bytes is corrected for the 1 in 256 that agree by chance.

Defined results: a text without words has the empty fingerprint, which is like
another empty one (1) and unlike all else (0); a text of 1 to 4 words has one
shingle, all its words; rows with equal ids are ordered by text; null ids come
last; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, arrow_map, cut, table
from .wordhash import mix, ngrams, split_words, word_hashes

BIN_BITS = 8
BINS = 1 << BIN_BITS
KEPT_BITS = 8
SHINGLE = 5
_ATTEMPTS = 4096


def _probes() -> np.ndarray:
    """Bin named for (attempt, bin)."""
    pairs = np.arange(_ATTEMPTS * BINS, dtype=np.uint64)
    return (mix(pairs, 31) >> np.uint64(64 - BIN_BITS)).astype(np.int64).reshape(_ATTEMPTS, BINS)


_PROBES: list[np.ndarray] = []


def sketches(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes per text and bin, whether the text has no words)."""
    b = split_words(texts)
    doc, h = ngrams(b, word_hashes(b), SHINGLE, short=True)
    n = b.n_docs
    low = np.full(n * BINS, np.iinfo(np.uint64).max, np.uint64)
    where = doc * BINS + (h >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    np.minimum.at(low, where, h & np.uint64((1 << (64 - BIN_BITS)) - 1))
    low = low.reshape(n, BINS)
    filled = low != np.iinfo(np.uint64).max
    blank = ~filled.any(axis=1)
    rows, bins = np.nonzero(~filled & ~blank[:, None])
    if len(rows):
        if not _PROBES:
            _PROBES.append(_probes())
        dense = low.copy()
        for attempt in range(_ATTEMPTS):
            named = _PROBES[0][attempt][bins]
            hit = filled[rows, named]
            dense[rows[hit], bins[hit]] = low[rows[hit], named[hit]]
            rows, bins = rows[~hit], bins[~hit]
            if not len(rows):
                break
        for r, k in zip(rows, bins, strict=True):  # a one in many millions case: the next filled bin
            step = (k + np.arange(BINS)) % BINS
            dense[r, k] = low[r, step[np.argmax(filled[r, step])]]
        low = dense
    return (low & np.uint64((1 << KEPT_BITS) - 1)).astype(np.uint8), blank


def likeness(a: np.ndarray, a_blank: np.ndarray, b: np.ndarray, b_blank: np.ndarray) -> np.ndarray:
    chance = 1.0 / (1 << KEPT_BITS)
    same = (a == b).mean(axis=1) if len(a) else np.zeros(0)
    near = np.clip((same - chance) / (1 - chance), 0.0, 1.0)
    return np.where(a_blank | b_blank, (a_blank & b_blank).astype(float), near)


def _packed(sketch: np.ndarray, blank: np.ndarray) -> pa.Array:
    return pa.array([b"" if e else s.tobytes() for s, e in zip(sketch, blank, strict=True)], pa.binary())


_OUT = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = [x.split()[0] for x in _OUT.split(", ")]


def _compared(texts: list[str], following: list[str]) -> list[pa.Array]:
    """The result columns of texts, each with the one that follows it."""
    edited = []
    for t, nxt in zip(texts, following, strict=True):
        half = len(t) // 2
        edited.append(t[: len(t) - half] + nxt[:half])
    own, own_blank = sketches(pa.array(texts, pa.string()))
    ed, ed_blank = sketches(pa.array(edited, pa.string()))
    # all but the last text's follower are texts of this chunk already
    last, last_blank = sketches(pa.array(following[-1:], pa.string()))
    nxt, nxt_blank = np.concatenate([own[1:], last]), np.concatenate([own_blank[1:], last_blank])
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        _packed(own, own_blank), _packed(ed, ed_blank),
        pa.array(likeness(own, own_blank, ed, ed_blank)), pa.array(likeness(own, own_blank, nxt, nxt_blank)),
    ]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints (packed), near_edited and
    near_next of every row, the next document being that of the next lower id
    (after the lowest: the highest).

    One range shuffle puts neighbours side by side.  A task compares the rows
    of its slice and hands out its first and last text, two rows per task; the
    pairs across slices are compared from these.
    """
    src = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ordered = src.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_no = TaskContext.get().partitionId()
        ids: list = []
        texts: list[str] = []
        held, edge, id_type = 0, None, None

        def rows(count: int) -> pa.RecordBatch:
            cols = _compared(texts[:count], texts[1 : count + 1])
            filler = [pa.array([0] * count, pa.int32()), pa.array([slice_no] * count, pa.int32()), pa.nulls(count, pa.string())]
            return pa.RecordBatch.from_arrays([pa.array(ids[:count], id_type), *cols, *filler], ["doc_id", *_NAMES, "edge", "slice", "text"])

        def edges(which: int) -> pa.RecordBatch:
            at = 0 if which == 1 else -1
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            more = [pa.array([which], pa.int32()), pa.array([slice_no], pa.int32()), pa.array([texts[at]], pa.string())]
            return pa.RecordBatch.from_arrays([pa.array([ids[at]], id_type), *empty, *more], ["doc_id", *_NAMES, "edge", "slice", "text"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc_id)
                texts.append(text.as_py())
                held += len(texts[-1])
                if edge is None:
                    edge = edges(1)
                    yield edge
                if held > CHUNK_BYTES and len(texts) > 1:
                    yield rows(len(texts) - 1)
                    ids, texts = ids[-1:], texts[-1:]
                    held = len(texts[0])
        if texts:
            if len(texts) > 1:
                yield rows(len(texts) - 1)
            yield edges(2)

    out = cut(arrow_map(ordered, compare, f"doc_id {kind}, {_OUT}, edge int, slice int, text string"), "compared")
    first = out.where("edge = 1").select(F.col("slice").alias("__slice"), F.col("text").alias("next_text"))
    # a row per task, whatever the number of documents
    order_of = Window.orderBy("slice")
    follows = out.where("edge = 1").select("slice").withColumn("__slice", F.coalesce(F.lead("slice").over(order_of), F.first("slice").over(order_of)))
    across = out.where("edge = 2").select("doc_id", "slice", "text").join(follows, "slice").join(first, "__slice").select("doc_id", "text", "next_text")

    def compare_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([row.column(0), *_compared(row.column(1).to_pylist(), row.column(2).to_pylist())], ["doc_id", *_NAMES])

    pairs = arrow_map(across, compare_pairs, f"doc_id {kind}, {_OUT}")
    return out.where("edge = 0").select("doc_id", *_NAMES).unionByName(pairs)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprint_documents(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
