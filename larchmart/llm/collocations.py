"""Phrase collocation mining by dynamic itemset counting (operator 12).

A phrase is one to ``LONGEST`` consecutive words of a piece of text, and belongs to
its language.  The texts are split once into blocks of bounded size, dealt over
``SHARDS`` shards; a block holds its distinct words, their counts, and its words in
order.  The shards are then scanned in cycles.  In every step one shard is read, and
every phrase that is active is counted in it, whatever its length:

* words are active from the first step;
* a longer phrase is active from the step after the one in which both its parts
  without the last and without the first word have reached the threshold;
* a phrase is counted for one full cycle from its own first step, so in every shard
  once, and the steps go on until no phrase is left within its cycle.

A step's counts are phrase digests with numbers, combined in the map tasks and summed
by a shuffle; a phrase's first step is a function of its digest, so it travels with
the counts as their cohort, and only cohorts within their cycle are summed again in
the next step.  What the scanning tasks need to know is in which step a phrase reached
the threshold: an array of ``SLOTS`` bytes per length, fixed in size, with two slots a
phrase.  Slots that phrases share make phrases active that are not: they are counted
for nothing, and no phrase that reaches the threshold is missed.  Digests that agree
add up, which also only lets more through.  One last scan therefore counts what was
let through by the words themselves: the result has exact counts of exact phrases.

Scores are made of these counts by joins: every cut of a phrase into a first part and a
rest, the lowest score, and the longest part of the phrase's uses that a longer phrase
accounts for.

Defined results: null text is empty; null language is ``und``; repeated rows count
each; texts without words add nothing; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, chunks, cut, shared_path, table, text_or_empty
from .wordhash import mix, span_hashes, text_bytes

LONGEST = 4
SHARDS = 3
#: Slots per length of what has reached the threshold (a power of two).
SLOTS = 1 << 24
#: Of the query.
THRESHOLD = 30
TOP = 2000
NO_LANGUAGE = "und"
#: A phrase goes if a longer one has COVERED percent of its uses.
COVERED = 80
SCALE = 2_000_000

_U = np.uint64
_NEVER = 255
_BUCKET = 32768  # positions in one bitmap of bitmap_construct_agg
#: Bytes between words and between pieces (fixed values of the contract).
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = True
_BREAK[0x0A:0x0E] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: One odd factor per place of a word in a phrase.
_PLACE = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0x27D4EB2F165667C5)]

_BLOCKS = "lang string, words array<string>, digests array<long>, counts array<long>, sequence binary, shard int"


# -- blocks ------------------------------------------------------------------


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, and the words in order: place among the distinct ones
    plus 1, and 0 wherever a piece ends between two words."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    parting = _BREAK[data]
    inside = ~(_GAP[data] | parting)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if not len(start):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int32)
    lengths = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(lengths), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    coded = words.dictionary_encode()
    # a piece ends between two words where a parting byte or a text's edge lies
    stops = np.concatenate([[0], np.cumsum(parting)])
    texts_at = np.searchsorted(offsets, start, "right")
    apart = (stops[start[1:]] != stops[end[:-1]]) | (texts_at[1:] != texts_at[:-1])
    at = np.arange(len(start)) + np.concatenate([[0], np.cumsum(apart)])
    sequence = np.zeros(int(at[-1]) + 1, np.int32)
    sequence[at] = coded.indices.to_numpy().astype(np.int32) + 1
    return coded.dictionary, sequence


def _word_digests(words: pa.Array, lang: str) -> np.ndarray:
    _, off, data = words.buffers()
    offsets = np.frombuffer(off, np.int64)[words.offset : words.offset + len(words) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    h = span_hashes(flat, offsets[:-1], [offsets[1:]])[0]
    code = lang.encode()
    salt = _U(zlib.crc32(code) << 32 | zlib.adler32(code))
    return mix(h ^ mix(np.array([salt], _U), 1)[0], 2)


def _blocks(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for batch in chunks(batches):
            langs = batch.column(1)
            for lang in pc.unique(langs).to_pylist():
                words, sequence = _tokens(batch.column(0).filter(pc.equal(langs, lang)))
                if not len(words):
                    continue
                counts = np.bincount(sequence, minlength=len(words) + 1)[1:]
                row = [lang, words.cast(pa.large_string()), _word_digests(words, lang).view(np.int64), counts, sequence.tobytes(), number % shards]
                number += 1
                columns = [
                    pa.array([row[0]], pa.string()),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), row[1].cast(pa.string())),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(row[2])),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(row[3].astype(np.int64))),
                    pa.array([row[4]], pa.binary()),
                    pa.array([row[5]], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "words", "digests", "counts", "sequence", "shard"])

    return run


def blocks_of(docs: DataFrame, shards: int) -> DataFrame:
    """The blocks of all texts, stored by shard."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE))
    made = arrow_map(docs.select(text_or_empty().alias("text"), lang.alias("lang")), _blocks(shards), _BLOCKS)
    path = shared_path(docs.sparkSession, "blocks")
    made.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(_BLOCKS).parquet(path)


# -- one scan ----------------------------------------------------------------


def _digest(parts: list[np.ndarray]) -> np.ndarray:
    """Digest of phrases given the digests of their words; the two lowest bits
    hold the length less one."""
    if len(parts) == 1:
        h = parts[0]
    else:
        h = parts[0] * _PLACE[0]
        for p, factor in zip(parts[1:], _PLACE[1:], strict=False):
            h = h + p * factor
        h = mix(h, 3 + len(parts))
    return (h & ~_U(3)) | _U(len(parts) - 1)


def _reached(slots: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Step in which a phrase reached the threshold, or _NEVER."""
    mask = _U(len(slots) - 1)
    return np.maximum(slots[(digests >> _U(2)) & mask], slots[(digests >> _U(30)) & mask])


def _phrases(sequence: np.ndarray, digests: np.ndarray, slots: list[np.ndarray], wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, places, digests, first step) of the phrases of two words and more
    that may be counted: both parts have reached the threshold.  ``wanted`` says of
    first steps which of them are still asked for."""
    words = np.concatenate([np.zeros(1, _U), digests])
    reached = np.concatenate([[_NEVER], _reached(slots[0], _digest([digests]))]).astype(np.int16)
    at = np.flatnonzero(sequence)  # places of the phrases of one word less
    step = reached[sequence[at]]
    keep = step != _NEVER
    at, step = at[keep], step[keep]
    for length in range(2, LONGEST + 1):
        follows = np.flatnonzero(at[1:] == at[:-1] + 1)
        first = np.maximum(step[follows], step[follows + 1]) + 1
        at = at[follows]
        h = _digest([words[sequence[at + j]] for j in range(length)])
        asked = wanted(first)
        yield length, at[asked], h[asked], first[asked]
        if length == LONGEST or not len(at):
            return
        step = _reached(slots[length - 1], h).astype(np.int16)
        keep = step != _NEVER
        at, step = at[keep], step[keep]


def _unpacked(filters) -> list[np.ndarray]:
    return [np.frombuffer(zlib.decompress(x), np.uint8) for x in filters.value]


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    for i in range(batch.num_rows):
        lang, words, digests, counts, sequence = (batch.column(j)[i] for j in range(5))
        yield lang.as_py(), words.values, digests.values.to_numpy().view(_U), counts.values.to_numpy(), np.frombuffer(sequence.as_buffer(), np.int32)


def _scan(step: int, shards: int, filters):
    """Counts of the phrases that are active in a step: cohort, digest, number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _unpacked(filters)
        for batch in batches:
            for _, _, digests, counts, sequence in _rows_of(batch):
                found = []
                if step < shards:
                    found.append((np.zeros(len(digests), np.int32), _digest([digests]), counts))
                active = lambda first: (first <= step) & (first > step - shards)
                for _, _, h, first in _phrases(sequence, digests, slots, active):
                    h, i, n = np.unique(h, return_index=True, return_counts=True)
                    found.append((first[i].astype(np.int32), h, n))
                for cohort, h, n in found:
                    if len(h):
                        yield pa.RecordBatch.from_arrays([pa.array(cohort), pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["cohort", "h", "n"])

    return run


def _named(filters):
    """Counts, by words, of all phrases of a block that may have reached the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _unpacked(filters)
        for batch in batches:
            for lang, words, digests, counts, sequence in _rows_of(batch):
                fine = np.flatnonzero(_reached(slots[0], _digest([digests])) != _NEVER)
                found = [(1, [fine], counts[fine])]
                for length, at, h, _ in _phrases(sequence, digests, slots, lambda first: first >= 0):
                    at = at[_reached(slots[length - 1], h) != _NEVER]
                    # the same words have the same places among the block's words: exact
                    key = sequence[at].astype(np.int64) - 1
                    for j in range(1, length):
                        if j > 1:
                            key = np.unique(key, return_inverse=True)[1]
                        key = key * len(words) + sequence[at + j] - 1
                    _, i, n = np.unique(key, return_index=True, return_counts=True)
                    found.append((length, [sequence[at[i] + j] - 1 for j in range(length)], n))
                for length, parts, n in found:
                    if len(n):
                        taken = [words.take(pa.array(p)) for p in parts]
                        phrase = taken[0] if length == 1 else pc.binary_join_element_wise(*taken, " ")
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(np.full(len(n), length, np.int32)), phrase.cast(pa.string()), pa.array(n.astype(np.int64))], ["lang", "len", "phrase", "n"])

    return run


# -- cycles ------------------------------------------------------------------


def _mark(reached: DataFrame, slots: list[np.ndarray], step: int) -> list[bool]:
    """Enter the phrases that reached the threshold in ``step``; returns which
    lengths had any.  What comes to the driver is one bit a slot at most."""
    digest = F.col("h")
    places = F.array(*[F.shiftrightunsigned(digest, shift).bitwiseAND(F.lit(len(slots[0]) - 1)) + 1 for shift in (2, 30)])
    bits = reached.select(digest.bitwiseAND(F.lit(3)).alias("len"), F.explode(places).alias("slot"))
    maps = bits.groupBy("len", F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    seen = [False] * LONGEST
    for row in maps.collect():
        seen[row["len"]] = True
        at = (row["bucket"] - 1) * _BUCKET
        part = slots[row["len"]][at : at + _BUCKET]
        new = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")[: len(part)].astype(bool)
        part[new & (part == _NEVER)] = step
    return seen


def frequent_phrases(docs: DataFrame, threshold: int, *, shards: int = SHARDS, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """(lang, len, phrase, n) of all phrases found ``threshold`` times or more, and
    (lang, n) of all words, by dynamic itemset counting (see module doc)."""
    if not 1 <= shards <= _NEVER // (LONGEST + 1):
        raise ValueError(f"shards: {shards}")
    spark = docs.sparkSession
    blocks = blocks_of(docs, shards)
    columns = ["lang", "words", "digests", "counts", "sequence"]
    known = [np.full(slots, _NEVER, np.uint8) for _ in range(LONGEST)]
    packed = lambda: spark.sparkContext.broadcast([zlib.compress(x.tobytes(), 1) for x in known])
    within, pending, step = {0}, None, 0
    filters = packed()
    # the first step of a phrase is at most 1 + that of its parts + a cycle, so the steps end
    while any(first <= step < first + shards for first in within):
        light = blocks.where(F.col("shard") == step % shards).select("lang", F.array().cast("array<string>").alias("words"), *columns[2:])
        counted = arrow_map(light, _scan(step, shards, filters), "cohort int, h long, n long").withColumn("before", F.lit(0).cast("long"))
        if pending is not None:
            counted = counted.unionByName(pending.where(F.col("cohort") > step - shards).select("cohort", "h", "n", F.col("n").alias("before")))
        pending = cut(counted.groupBy("cohort", "h").agg(F.sum("n").alias("n"), F.sum("before").alias("before")), f"counts-{step}")
        new = _mark(pending.where((F.col("n") >= threshold) & (F.col("before") < threshold)), known, step)
        if any(new[:-1]):
            within.add(step + 1)
        filters.unpersist()
        filters, step = packed(), step + 1
    names = arrow_map(blocks.select(*columns), _named(filters), "lang string, len int, phrase string, n long")
    frequent = names.groupBy("lang", "len", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= threshold)
    totals = blocks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    return cut(frequent, "phrases"), totals


# -- scores ------------------------------------------------------------------


def _whole(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, **how) -> DataFrame:
    """lang, phrase, len, a, k, l, r, n, score and covered (whether a longer phrase
    accounts for it) of every phrase of two words and more (see module doc)."""
    frequent, totals = frequent_phrases(docs, threshold, **how)
    phrases = frequent.where("len > 1").withColumnRenamed("n", "a")
    sides = F.explode(
        F.expr(
            "flatten(transform(sequence(1, len - 1), k -> array("
            "named_struct('k', k, 'first', true, 'part', substring_index(phrase, ' ', k)),"
            "named_struct('k', k, 'first', false, 'part', substring_index(phrase, ' ', k - len)))))"
        )
    ).alias("side")
    cuts = phrases.select("lang", "phrase", "a", sides).select("lang", "phrase", "a", "side.*")
    parts = frequent.select(F.col("lang").alias("__lang"), F.col("phrase").alias("__phrase"), "n")
    found = cuts.join(parts, (F.col("lang") == F.col("__lang")) & (F.col("part") == F.col("__phrase")))
    both = found.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("first"), F.col("n"))).alias("l"), F.max(F.when(~F.col("first"), F.col("n"))).alias("r"))
    # decimals: a product may pass 64 bits; div is exact
    both = both.withColumn("score", F.expr(f"(cast(a as decimal(19,0)) * cast({SCALE} as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    least = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # every part of two words and more, with the most that a longer phrase has
    inner = F.explode(
        F.expr(
            "flatten(transform(sequence(2, greatest(2, len - 1)), size -> transform(sequence(0, len - size), at ->"
            " substring_index(substring_index(phrase, ' ', at + size), ' ', -size))))"
        )
    ).alias("__phrase")
    longer = phrases.where("len > 2").select(F.col("lang").alias("__lang"), inner, F.col("a").alias("most")).groupBy("__lang", "__phrase").agg(F.max("most").alias("most"))
    scored = least.join(longer, (F.col("lang") == F.col("__lang")) & (F.col("phrase") == F.col("__phrase")), "left")
    covered = F.coalesce(_whole("most") * 100 >= _whole("a") * COVERED, F.lit(False))
    scored = scored.select("lang", "phrase", "a", "cut.*", covered.alias("covered"))
    return scored.join(totals.select(F.col("lang").alias("__of"), F.col("n")), F.col("lang") == F.col("__of")).drop("__of")


def best_collocations(docs: DataFrame, top: int, threshold: int = THRESHOLD, **how) -> DataFrame:
    """The ``top`` uncovered phrases of every language (lang, rank, phrase, a, l, r, n, score)."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(docs, threshold, **how).where(~F.col("covered")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest collocations of every language of ``documents``."""
    return best_collocations(table(spark, sf_dir, "documents"), TOP)


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM pieces
), f AS (
  SELECT lang, len, phrase, count(*) AS n FROM (
    SELECT lang, len, unnest(list_transform(range(1, len(ws) - len + 2), lambda i: array_to_string(ws[i:i + len - 1], ' '))) AS phrase
    FROM w, (SELECT unnest([1, 2, 3, 4]) AS len) WHERE len(ws) >= len
  ) GROUP BY lang, len, phrase
), totals AS (
  SELECT lang, sum(n) AS n FROM f WHERE len = 1 GROUP BY lang
), c AS (
  SELECT lang, len, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE len > 1 AND n >= 30
), cuts AS (
  SELECT lang, len, phrase, a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, len)) AS k FROM c)
), scored AS (
  SELECT cuts.lang, cuts.len, cuts.phrase, a, k, h.n AS l, t.n AS r,
         CAST((2000000::HUGEINT * a) // (h.n + t.n) AS BIGINT) AS score
  FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = head JOIN f t ON t.lang = cuts.lang AND t.phrase = rest
), least AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM least WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.lang = least.lang AND c.len > least.len
      AND contains(' ' || c.phrase || ' ', ' ' || least.phrase || ' ') AND 100 * c.a >= 80 * least.a)
), ranked AS (
  SELECT kept.*, totals.n, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM kept JOIN totals ON totals.lang = kept.lang
)
SELECT lang, rank, phrase, a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score FROM ranked WHERE rank <= 2000
"""
