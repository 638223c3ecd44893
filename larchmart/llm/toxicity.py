"""Toxicity by a linear-chain conditional random field (operator 10).

Tokens get a label from the labelled documents: a token of a toxic document is
toxic when one of its features (the word or one of its beginnings) is evidence,
that is, found much more often in toxic documents than in others, or found much
more often there twice or more in a document (a stem that clean words begin
with too shows in the number of its forms).  Evidence is counted over all
labelled documents that are not held out; copies share one document's weight.
A chain of two states (toxic or not) is fitted to the tokens of a sample; forward-backward marginals give every
token of a text its probability, and what they sum to, their largest and their
density give the document's score through a logistic curve fitted on labelled
documents that the chain has not seen.  Tokens of probability 0.5 and more are
returned as spans with their code point offsets.

The chain and the curve use a bounded sample of these rows: at most
``SAMPLE_TOXIC`` and ``SAMPLE_OTHER`` documents of at most ``SAMPLE_CHARS`` code
points each and ``SAMPLE_TEXT`` together, the first by a hash of the id.
Scoring covers whole texts.

Defined results: a null text is an empty one and gets the score of a text
without toxic tokens; with no label of one of the two kinds every score is the
share of toxic labels (0 without labels); repeated labels of an id count as
toxic if one is; rows without an id are scored like all others; an empty table
gives an empty result; other columns are kept, one named like an added column
is replaced by it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import FILTER_BITS, FILTER_BLOCK, arrow_map, chunks, cut, may_match, slot_bits, table, without
from .wordhash import distinct, ngrams, span_hashes, split_words, word_hashes

SAMPLE_TOXIC = 1200
SAMPLE_OTHER = 1800
SAMPLE_CHARS = 100_000
SAMPLE_TEXT = 16_000_000
LIMIT = 0.7
#: Weights of the chain; features are hashed into them.
BUCKETS = 1 << 18
#: Code points of the beginnings of a longer word that are features, besides the word.
PREFIXES = (7, 6, 5, 4, 3)
WINDOW = 64
ROUNDS = 60
#: A feature is evidence when it is found this many times as often in toxic documents,
#: and the likelihood ratio statistic says that this is no accident among very many features.
EVIDENCE_RATIO = 12.0
EVIDENCE_G2 = 25.0
EVIDENCE_IMPURE = 0.1

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True


@dataclass
class Model:
    weights: np.ndarray  # score of the toxic state per feature bucket
    bias: float
    trans: np.ndarray  # 2 x 2 log weights of neighbouring states
    curve: np.ndarray  # constant and factors of the document's figures
    constant: float | None = None  # the score of all, where nothing could be fitted


def constant_model(score: float) -> Model:
    return Model(np.zeros(0), 0.0, np.zeros((2, 2)), np.zeros(4), score)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def features(texts: pa.Array):
    """The words of the texts, without punctuation around, and their feature
    buckets (tokens x features; bucket 0 where a word is too short for one)."""
    b, start, end, keys = feature_keys(texts)
    return b, start, end, buckets(keys)


def buckets(keys: np.ndarray) -> np.ndarray:
    return np.where(keys > 0, keys % np.uint64(BUCKETS - 1) + np.uint64(1), np.uint64(0)).astype(np.int32)


def feature_keys(texts: pa.Array):
    """The words of the texts and the 64-bit hashes of their features (0: none)."""
    b = split_words(texts, lower=True)
    start, end = b.start.copy(), b.end.copy()
    for _ in range(6):
        end -= ((end > start + 1) & _PUNCTUATION[b.data[end - 1]]).astype(end.dtype) if len(end) else 0
        start += ((end > start + 1) & _PUNCTUATION[b.data[start]]).astype(start.dtype) if len(end) else 0
    lead = np.flatnonzero((b.data & 0xC0) != 0x80)  # where code points begin
    nth = np.searchsorted(lead, start)
    lead = np.concatenate([lead, np.full(max(PREFIXES) + 1, len(b.data))])
    ends = [end, *[np.minimum(lead[nth + n], end) for n in PREFIXES]]
    hashes = span_hashes(b.data, start, ends)
    out = np.zeros((len(start), len(ends)), np.uint64)
    for j, h in enumerate(hashes):
        key = h + np.uint64(j * 0x9E3779B1)
        out[:, j] = key if j == 0 else np.where(ends[j] < end, key, np.uint64(0))
    return b, start, end, out


def _windows(doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Tokens laid out in windows of one text each (windows x WINDOW, -1: none)."""
    if not len(doc):
        return np.zeros((0, WINDOW), np.int64)
    at = np.arange(len(doc)) - first[doc]
    begins = np.flatnonzero(at % WINDOW == 0)
    length = np.diff(np.concatenate([begins, [len(doc)]]))
    grid = begins[:, None] + np.arange(WINDOW)
    return np.where(np.arange(WINDOW) < length[:, None], grid, -1)


def _ratios(odds: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward ratios of the toxic to the other state; ``odds`` is
    positions x chains, with nan past a chain's end."""
    t = np.exp(trans)
    ahead, back = np.empty_like(odds), np.empty_like(odds)
    ahead[0] = odds[0]
    for k in range(1, len(odds)):
        ahead[k] = odds[k] * (t[0, 1] + ahead[k - 1] * t[1, 1]) / (t[0, 0] + ahead[k - 1] * t[1, 0])
    back[-1] = 1.0
    for k in range(len(odds) - 2, -1, -1):
        on = odds[k + 1] * back[k + 1]
        back[k] = np.where(np.isnan(odds[k + 1]), 1.0, (t[1, 0] + on * t[1, 1]) / (t[0, 0] + on * t[0, 1]))
    return ahead, back


def marginals(scores: np.ndarray, grid: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Probability of the toxic state of every token."""
    p = np.zeros(len(scores))
    if not len(scores):
        return p
    odds = np.where(grid >= 0, np.exp(np.clip(scores, -30, 30))[grid], np.nan).T
    ahead, back = _ratios(odds, trans)
    both = ahead * back
    share = (both / (1 + both)).T
    p[grid[grid >= 0]] = share[grid >= 0]
    return p


def copy_groups(texts: pa.Array) -> np.ndarray:
    """The first text of the group of copies of every text.  Copies, near ones
    too, agree in some pair of neighbours among their smallest shingle hashes;
    counted apart, the words of a text with many copies would look like signs."""
    b = split_words(texts, lower=True)
    doc, h = distinct(*ngrams(b, word_hashes(b), 5, short=True))
    first = np.searchsorted(doc, np.arange(b.n_docs + 1))
    group, met = np.arange(b.n_docs), {}

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = i = group[group[i]]
        return i

    for i in range(b.n_docs):
        low = h[first[i] : min(first[i + 1], first[i] + 6)].tolist()
        for pair in zip(low, low[1:] or low, strict=False):
            j = root(met.setdefault(pair, i))
            k = root(i)
            group[max(j, k)] = min(j, k)
    return np.array([root(i) for i in range(b.n_docs)], np.int64)


def copy_weights(training: DataFrame) -> DataFrame:
    """__id, weight: one over the number of documents with the same label that
    share most of a document's smallest shingle hashes with it, so that all copies
    of a text, near ones too, weigh about as much as one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            b = split_words(batch.column(2), lower=True)
            doc, h = distinct(*ngrams(b, word_hashes(b), 5, short=True))
            first = np.searchsorted(doc, np.arange(b.n_docs + 1))
            at = np.concatenate([np.arange(x, max(x + 1, min(y, x + 6) - 1)) for x, y in zip(first, first[1:], strict=False) if y > x] or [np.zeros(0, int)])
            pair = h[at] ^ (np.where(np.append(doc[1:], -1)[at] == doc[at], np.append(h[1:], h[:1])[at], h[at]) * np.uint64(0x9E3779B97F4A7C15))
            owner = pa.array(doc[at])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), batch.column(1).take(owner), pa.array(pair.view(np.int64))], ["__id", "toxic", "pair"])

    kind = training.schema["__id"].dataType.simpleString()
    pairs = cut(arrow_map(training.select("__id", "toxic", "text"), run, f"__id {kind}, toxic int, pair long"), "pairs")
    shared = pairs.groupBy(F.col("toxic").alias("__t"), F.col("pair").alias("__p")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = pairs.join(shared, (F.col("toxic") == F.col("__t")) & (F.col("pair") == F.col("__p")))
    return met.groupBy("__id").agg((1 / F.max("n")).alias("weight"))


def _counts(rows: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """key, once, twice: the weight of the documents that hold a feature, and of
    those that hold it twice or more; ``bits`` tells the features that matter."""
    shared = None if bits is None else rows.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if shared is None else np.unpackbits(shared.value, bitorder="little").astype(bool)
        for batch in chunks(batches):
            b, _, _, keys = feature_keys(batch.column(0))
            doc, key = np.repeat(b.doc, keys.shape[1]), keys.ravel()
            use = key > 0
            if wanted is not None:
                use &= wanted[key & np.uint64(FILTER_BITS - 1)]
            doc, key = doc[use], key[use]
            if not len(key):
                continue
            order = np.lexsort((key, doc))
            doc, key = doc[order], key[order]
            begin = np.concatenate([[0], np.flatnonzero((doc[1:] != doc[:-1]) | (key[1:] != key[:-1])) + 1])
            often = np.diff(np.concatenate([begin, [len(key)]])) > 1
            weight = batch.column(1).to_numpy()[doc[begin]]
            found, which = np.unique(key[begin], return_inverse=True)
            sums = [np.bincount(which, w, len(found)) for w in (weight, weight * often)]
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), *[pa.array(x) for x in sums]], ["key", "once", "twice"])

    parts = arrow_map(rows.select("text", "weight"), run, "key long, once double, twice double")
    return parts.groupBy("key").agg(F.sum("once").alias("once"), F.sum("twice").alias("twice"))


def _slots(keys: DataFrame) -> np.ndarray:
    out = np.zeros(FILTER_BITS, bool)
    for r in slot_bits(keys).collect():
        out[r["at"] * FILTER_BLOCK : (r["at"] + 1) * FILTER_BLOCK] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
    return out


def evidence(training: DataFrame) -> DataFrame:
    """key: the features that are evidence, from all rows of ``training`` (__id, toxic, text)."""
    weighed = training.join(copy_weights(training).withColumnRenamed("__id", "__w"), F.col("__id") == F.col("__w"), "left")
    weighed = cut(weighed.select("toxic", "text", F.coalesce("weight", F.lit(1.0)).alias("weight")), "weighed")
    total = {r["toxic"]: r["n"] for r in weighed.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()}  # two numbers
    n_toxic, n_other = total.get(1, 0.0), total.get(0, 0.0)
    if not n_toxic or not n_other:
        return training.sparkSession.createDataFrame([], "key long")
    share = n_toxic / (n_toxic + n_other)
    # a feature of fewer toxic documents cannot reach the statistic, whatever the others hold
    least = EVIDENCE_G2 / 2 / -np.log(share) - 1e-6
    in_toxic = cut(_counts(weighed.where("toxic = 1")).where(F.col("once") >= least), "toxic")
    in_other = _counts(weighed.where("toxic = 0"), _slots(in_toxic))
    other = in_other.select(F.col("key").alias("__key"), F.col("once").alias("o_once"), F.col("twice").alias("o_twice"))
    both = in_toxic.join(other, F.col("key") == F.col("__key"), "left").fillna(0.0, ["o_once", "o_twice"])

    def sign(a: Column, b: Column) -> Column:
        def part(x: Column, p: float) -> Column:
            return F.when(x > 0, x * F.log(x / ((a + b) * p))).otherwise(0.0)

        rate = (a / n_toxic) / ((b + 0.5) / n_other)
        return (rate >= EVIDENCE_RATIO) & (2 * (part(a, share) + part(b, 1 - share)) >= EVIDENCE_G2) & (b <= a * EVIDENCE_IMPURE)

    return both.where(sign(F.col("once"), F.col("o_once")) | sign(F.col("twice"), F.col("o_twice"))).select("key")


def with_signs(sample: DataFrame, found: DataFrame) -> DataFrame:
    """``sample`` with ``signs``: the features of a toxic document that are evidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            b, _, _, keys = feature_keys(batch.column(1))
            doc, key = distinct(np.repeat(b.doc, keys.shape[1]), keys.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array(key.view(np.int64))], ["__of", "__key"])

    kind = sample.schema["__id"].dataType.simpleString()
    held = arrow_map(sample.where("toxic = 1").select("__id", "text"), run, f"__of {kind}, __key long")
    signs = held.join(found, F.col("__key") == F.col("key")).groupBy("__of").agg(F.collect_list("key").alias("signs"))
    return sample.join(signs, F.col("__id") == F.col("__of"), "left").drop("__of")


def _fit_chain(feats: np.ndarray, label: np.ndarray, grid: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Maximum likelihood with a small L2 penalty, by Adagrad on all tokens."""
    used, local = np.unique(feats, return_inverse=True)
    local = local.reshape(feats.shape)
    w, bias, trans = np.zeros(len(used)), -3.0, np.zeros((2, 2))
    silent = used == 0
    sw, sb, st = np.full(len(used), 1e-8), 1e-8, np.full((2, 2), 1e-8)
    y = np.where(grid >= 0, label[grid], 0).T.astype(int)
    live = (grid >= 0).T
    pair = live[1:] & live[:-1]
    seen = np.array([[(pair & (y[:-1] == i) & (y[1:] == j)).sum() for j in (0, 1)] for i in (0, 1)], float)
    for _ in range(ROUNDS):
        scores = w[local].sum(axis=1) + bias
        odds = np.where(grid >= 0, np.exp(np.clip(scores, -30, 30))[grid], np.nan).T
        ahead, back = _ratios(odds, trans)
        both = ahead * back
        share = np.where(live, both / (1 + both), 0.0)
        p = np.zeros(len(scores))
        p[grid[grid >= 0]] = share.T[grid >= 0]
        err = p - label
        gw = np.bincount(local.ravel(), np.repeat(err, feats.shape[1]), len(used)) + 1e-3 * w
        gw[silent] = 0
        on = odds[1:] * back[1:]
        t = np.exp(trans)
        joint = np.array([[np.full_like(on, t[0, 0]), t[0, 1] * on], [ahead[:-1] * t[1, 0], ahead[:-1] * t[1, 1] * on]])
        joint /= joint.sum(axis=(0, 1))
        gt = np.where(pair, joint, 0.0).sum(axis=(2, 3)) - seen + 1e-3 * trans
        gb = err.sum()
        sw, sb, st = sw + gw * gw, sb + gb * gb, st + gt * gt
        w, bias, trans = w - 0.5 * gw / np.sqrt(sw), bias - 0.3 * gb / np.sqrt(sb), trans - 0.2 * gt / np.sqrt(st)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = w
    weights[0] = 0
    return weights, float(bias), trans


def _figures(doc: np.ndarray, p: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Per document: 1, log of the expected toxic tokens, the largest marginal, their density."""
    n = len(n_words)
    sure = np.where(p >= 0.3, p, 0.0)  # what a long clean text adds up to says nothing
    total = np.bincount(doc, sure, n) if len(doc) else np.zeros(n)
    top = np.zeros(n)
    np.maximum.at(top, doc, p)
    return np.stack([np.ones(n), np.log1p(total), top, np.sqrt(total / np.maximum(n_words, 1))], axis=1)


def _fit_curve(x: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small penalty."""
    c = np.zeros(x.shape[1])
    penalty = 0.05 * np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        grad = x.T @ (weight * (p - toxic)) + penalty @ c
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        c = c - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return c


def fit_sample(texts: list[str], toxic: np.ndarray, weight: np.ndarray, signs: list[list[int] | None]) -> Model:
    """Fit on a sample of labelled texts, in hash order, with the features of the
    toxic ones that are evidence; a third of them, copies together, is kept for the curve."""
    b, _, _, keys = feature_keys(pa.array(texts, pa.string()))
    feats = buckets(keys)
    group = copy_groups(pa.array(texts, pa.string()))
    for_curve = group % 3 == 2
    for kind in (toxic, ~toxic):  # with very few of a kind, all serve both
        if (kind & for_curve).sum() < 5 or (kind & ~for_curve).sum() < 5:
            for_curve = None
            break
    chain_doc = np.ones(len(texts), bool) if for_curve is None else ~for_curve
    curve_doc = chain_doc if for_curve is None else for_curve
    token = chain_doc[b.doc]
    known = np.unique(np.asarray([k for s in signs for k in s or ()], np.int64)).view(np.uint64)
    label = (np.isin(keys, known).any(axis=1) & toxic[b.doc]).astype(float)
    grid = _windows(b.doc, b.first)
    in_chain = chain_doc[b.doc[grid[:, 0]]]
    index = np.full(len(b.doc), -1)
    index[token] = np.arange(token.sum())
    chain_grid = np.where(grid[in_chain] >= 0, index[grid[in_chain]], -1)
    weights, bias, trans = _fit_chain(feats[token], label[token], chain_grid)
    p = marginals(weights[feats].sum(axis=1) + bias, grid, trans)
    x = _figures(b.doc, p, b.n_words)
    curve = _fit_curve(x[curve_doc], toxic[curve_doc].astype(float), weight[curve_doc])
    return Model(weights, bias, trans, curve)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Evidence from all of ``docs`` with ``labels`` (doc_id, toxic) that are not
    held out, chain and curve from their bounded sample."""
    per = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    per = per.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)")
    counts = {r["toxic"]: r["n"] for r in per.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_other = counts.get(1, 0), counts.get(0, 0)
    if not n_toxic or not n_other:
        return constant_model(float(bool(n_toxic)))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # of the texts without a label only those that pass a filter on the ids are moved
    likely = may_match(docs.select("doc_id", text.alias("text")), F.xxhash64("doc_id"), per.select(F.xxhash64(F.col("__id").cast(docs.schema["doc_id"].dataType)).alias("key")))
    training = cut(likely.join(per, F.col("doc_id") == F.col("__id")).select("__id", "toxic", "text"), "training")
    order = F.xxhash64("__id")
    ids = per.where("toxic = 1").orderBy(order, "__id").limit(SAMPLE_TOXIC).unionByName(per.where("toxic = 0").orderBy(order, "__id").limit(SAMPLE_OTHER))
    # the ids are at most SAMPLE_TOXIC + SAMPLE_OTHER rows
    rows = training.where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(ids.select(F.col("__id").alias("__s"))), F.col("__id") == F.col("__s")).drop("__s")
    rows = cut(rows.dropDuplicates(["__id"]), "sample")
    # one window over the bounded sample's lengths
    ahead = F.sum(F.length("text").cast("long")).over(Window.orderBy(order, "__id"))
    weight = F.when(F.col("toxic") == 1, F.lit(n_toxic / min(n_toxic, SAMPLE_TOXIC))).otherwise(F.lit(n_other / min(n_other, SAMPLE_OTHER)))
    rows = with_signs(rows.withColumn("ahead", ahead).where(F.col("ahead") <= SAMPLE_TEXT), evidence(training))
    rows = rows.orderBy(order, "__id").limit(SAMPLE_TOXIC + SAMPLE_OTHER).select("text", "toxic", weight.alias("weight"), "signs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = list(batches)  # the whole bounded sample
        if not sample:
            return
        t = pa.Table.from_batches(sample)
        toxic = t.column(1).to_numpy() == 1
        if not toxic.any() or toxic.all():
            model = constant_model(float(toxic.any()))
        else:
            weight = t.column(2).to_numpy()
            model = fit_sample(t.column(0).to_pylist(), toxic, weight * len(weight) / weight.sum(), t.column(3).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    fitted = arrow_map(rows, run, "model binary").collect()  # one model of BUCKETS weights
    return pickle.loads(fitted[0]["model"]) if fitted else constant_model(0.0)


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("p", T.DoubleType())]))


def score_texts(texts: pa.Array, model: Model) -> tuple[np.ndarray, list[list[dict]]]:
    """Score and toxic spans (code points, neighbours merged) of every text."""
    n = len(texts)
    spans: list[list[dict]] = [[] for _ in range(n)]
    if model.constant is not None:
        return np.full(n, model.constant), spans
    b, start, end, feats = features(texts)
    grid = _windows(b.doc, b.first)
    p = marginals(model.weights[feats].sum(axis=1) + model.bias, grid, model.trans)
    x = _figures(b.doc, p, b.n_words)
    score = 1 / (1 + np.exp(-np.clip(x @ model.curve, -30, 30)))
    hits = np.flatnonzero(p >= 0.5)
    if len(hits):
        points = np.concatenate([[0], np.cumsum((b.data & 0xC0) != 0x80)])
        last = -2
        for k in hits:
            d = int(b.doc[k])
            at = points[b.offsets[d]]
            s, e, q = int(points[start[k]] - at), int(points[end[k]] - at), float(p[k])
            if k == last + 1 and spans[d]:
                spans[d][-1]["end"], spans[d][-1]["p"] = e, max(q, spans[d][-1]["p"])
            else:
                spans[d].append({"start": s, "end": e, "p": q})
            last = k
    return score, spans


def score_toxicity(docs: DataFrame, model: Model, score_col: str = "score", spans_col: str = "toxic_spans") -> DataFrame:
    """``docs`` with the score (0 to 1) and the toxic spans of every whole text."""
    docs = without(docs, score_col, spans_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights, whatever the corpus
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            score, spans = score_texts(batch.column(batch.schema.get_field_index("text")), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array(spans, kind)], [*batch.schema.names, score_col, spans_col])

    src = docs.withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*src.schema.fields, T.StructField(score_col, T.DoubleType()), T.StructField(spans_col, _SPAN)])
    return arrow_map(src, run, schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"),
        F.array_join(F.transform("toxic_spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
    )
