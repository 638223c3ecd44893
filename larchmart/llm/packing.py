"""Best-fit packing of tokenised documents into sequences (operator 8).

Bulk-synchronous best-fit.  The pieces are sorted by length with a distributed
range sort, which gives every piece its rank.  A round then sweeps pieces and
gaps together from the longest down: gaps go on a stack as they are met, and a
piece takes the gap on top, the smallest one that holds it - its successor;
pieces that want the same gap get it by rank.  Gaps shrink by what they took,
the unplaced pieces open as many sequences as their tokens must need, largest
first, and the next round begins.

Lengths and gaps are integers up to the capacity and equal ones are
interchangeable, so the sweeps run on runs of equal lengths and runs of equal
gaps: their table has at most ``capacity`` rows however many pieces there are,
and its result is a plan of rank intervals.  The pieces themselves are only
range-sorted and joined with the plan.

Defined results: a null or empty text is one piece holding the closing id;
repeated rows are packed each; ties in length rank by id, then piece; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, chunks, cut, ship, table
from ..operators.ranking import global_rank

CAPACITY = 2048
CLOSING_ID = 0
# Fixed value: the word pattern of byte-level pre-tokenizers that use their own pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_ranks(spec: dict, tokenize) -> dict[bytes, int] | None:
    """The rank of every token of a ``tokenizers`` file, if the file says nothing
    else than words by PATTERN and byte pairs by rank; None otherwise.

    That is: no normalizer, the byte-level pattern without a blank in front, a
    plain BPE model, ids of merged tokens that ascend with their merges, a token
    per byte, and no token that the merges do not reach (``tokenize`` gives the
    ids of a spelled word).  Then joining the neighbours whose bytes have the
    least rank is what the merges do."""
    words, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = words.get("type") == "ByteLevel" and words.get("add_prefix_space") is False and words.get("use_regex") is True
    plain &= model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or any(spec.get(k) for k in ("normalizer", "truncation", "padding")):
        return None
    # printable stand-ins for bytes: the printable ones stand for themselves, the others follow from 256 on
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(kept))}
    added = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = {t: i for t, i in model["vocab"].items() if t not in added}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    made = [vocab.get(t, -1) for t in merged]
    singles = [vocab[c] for c in spelled if c in vocab]
    if len(singles) < 256 or sorted(singles + made) != sorted(vocab.values()) or any(x >= y for x, y in zip([max(singles), *made], made, strict=False)):
        return None
    if any(set(t) - spelled.keys() or tokenize(t) != [i] for t, i in vocab.items()):
        return None
    return {bytes(spelled[c] for c in t): i for t, i in vocab.items()}


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, from a ``tokenizers`` file.

    The file defines the ids.  ``tiktoken`` gives the same ids several times
    faster from the ranks of a file that ``byte_ranks`` accepts; with any other
    file, and for texts that hold the spelling of an added token, all ids come
    from ``tokenizers``.  The choice depends on the file alone."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        ranks = byte_ranks(spec, lambda word: [t.id for t in self.exact.model.tokenize(word)])
        self.fast = None
        if ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding("same", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            return self._exact(text)
        return array("I", self.fast.encode_ordinary(text)).tobytes()

    def _exact(self, text: str) -> bytes:
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


#: A worker reads a file once.
_ENCODERS: dict[str, Encoder] = {}
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized_pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document's ids (closing id included): a longer
    document is cut from its end, so that only its first piece may be short.

    ``tokenizer_path`` must exist on every worker; by default each worker asks
    its installed ``public_tokenizers``."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer_path
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        encode = _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))
        closing = np.asarray([CLOSING_ID], "<u4").tobytes()
        for batch in chunks(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + closing
                n = len(ids) // 4
                first = n % capacity or capacity
                cuts = [0, *range(first, n + 1, capacity)]
                rows += [(doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), pieces, _PIECES.replace("doc_id long", f"doc_id {kind}"))


def plan_rounds(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Best-fit rounds over runs: yields (length, first rank, last rank + 1,
    first sequence, offset), ranks within the length, from 0.

    ``lengths`` descend, all below ``capacity``; each has ``counts`` pieces."""
    # a gap run: sequences first .. first + n - 1, each with `gap` tokens left
    left = {int(ln): int(c) for ln, c in zip(lengths, counts, strict=True) if c}
    used: dict[int, int] = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}
    opened = 0

    def give(ln: int, first: int, n: int, gap: int) -> tuple[int, int, int, int, int]:
        row = (ln, used[ln], used[ln] + n, first, capacity - gap)
        used[ln] += n
        left[ln] -= n
        if not left[ln]:
            del left[ln]
        if gap > ln:
            fresh.setdefault(gap - ln, []).append((first, n))
        return row

    while left:
        # successor sweep: from the longest down, a piece takes the smallest gap met so far
        fresh: dict[int, list[tuple[int, int]]] = {}
        stack: list[tuple[int, int, int]] = []
        todo = sorted(gaps, reverse=True)
        at, placed = 0, False
        for ln in sorted(left, reverse=True):
            while at < len(todo) and todo[at] >= ln:
                stack += [(todo[at], first, n) for first, n in gaps[todo[at]]]
                at += 1
            while stack and left.get(ln):
                gap, first, n = stack.pop()
                take = min(n, left[ln])
                if take < n:
                    stack.append((gap, first + take, n - take))
                yield give(ln, first, take, gap)
                placed = True
        rest: dict[int, list[tuple[int, int]]] = {}
        for gap, first, n in stack:
            rest.setdefault(gap, []).append((first, n))
        for gap in todo[at:]:
            rest.setdefault(gap, []).extend(gaps[gap])
        for gap, runs in fresh.items():
            rest.setdefault(gap, []).extend(runs)
        gaps = rest
        if placed and any(g >= min(left, default=capacity + 1) for g in gaps):
            # gaps that took a piece may take another before sequences are opened
            if max(gaps) >= max(left, default=0):
                continue
        # what no gap holds opens sequences: as many as its tokens must need
        most = max(gaps, default=0)
        over = sum(ln * n for ln, n in left.items() if ln > most)
        new = -(-over // capacity)
        fresh = {}
        for ln in sorted(left, reverse=True):
            if new <= 0 or ln <= most:
                break
            n = min(new, left[ln])
            yield give(ln, opened, n, capacity)
            opened += n
            new -= n
        for gap, runs in fresh.items():
            gaps.setdefault(gap, []).extend(runs)


def _planner(capacity: int):
    def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = list(frames)  # at most `capacity` rows in all
        if not runs:
            return
        hist = pd.concat(runs).sort_values("length", ascending=False)
        rows = list(plan_rounds(hist["length"].to_numpy(), hist["n"].to_numpy(), capacity))
        yield pd.DataFrame(rows, columns=["plan_length", "rank_from", "rank_to", "first_sequence", "offset"], dtype="int64")

    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (length from 1 to ``capacity``) with sequence_id and offset."""
    order = [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("start"), F.col("ids_crc32")]
    ranked = cut(global_rank(pieces, order, rank_col="__rank", total_col="__total").drop("__total"), "ranked")
    ship(pieces.sparkSession)
    # a row per length: bounded by the capacity, so the window over it is too
    hist = cut(ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.min("__rank").alias("first_rank")), "lengths")
    full = hist.where(F.col("length") == capacity).select(F.coalesce(F.max("n"), F.lit(0)).alias("n"))
    n_full = full.first()["n"]  # one number
    plan = cut(
        hist.where(F.col("length") < capacity).select("length", "n").coalesce(1).mapInPandas(
            _planner(capacity), "plan_length long, rank_from long, rank_to long, first_sequence long, offset long"
        ),
        "plan",
    )
    # full pieces fill sequences of their own, numbered by rank; the others follow
    whole = ranked.where(F.col("length") == capacity).withColumn("sequence_id", F.col("__rank") - 1).withColumn("offset", F.lit(0).cast("long"))
    starts = hist.select(F.col("length").alias("__length"), "first_rank")
    # both tables below are bounded by the capacity, whatever the number of pieces
    part = ranked.where(F.col("length") < capacity).join(F.broadcast(starts), F.col("length") == F.col("__length"))
    in_length = F.col("__rank") - F.col("first_rank")
    part = part.join(
        F.broadcast(plan), (F.col("length") == F.col("plan_length")) & (in_length >= F.col("rank_from")) & (in_length < F.col("rank_to"))
    ).withColumn("sequence_id", F.lit(n_full) + F.col("first_sequence") + in_length - F.col("rank_from"))
    keep = [*pieces.columns, "sequence_id", "offset"]
    return whole.select(*keep).unionByName(part.select(*keep))


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(cut(tokenized_pieces(docs, tokenizer_path, capacity), "pieces"), capacity)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
