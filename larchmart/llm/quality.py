"""Quality rules by robust multivariate outliers (operator 7).

Every text gives a vector of transformed statistics.  Per language and source,
minimum-covariance-determinant estimates of centre and scatter are found by
concentration steps over all its documents: from several robust starts (medians
with absolute deviations, with the covariance of the hyperbolic tangents and of
the spatial signs), keep the half with the least Mahalanobis distance,
re-estimate from them, and repeat until the determinant stops falling; the
start with the least determinant gives the model, re-estimated once from all
vectors within its 97.5% quantile.  Equal vectors of a model weigh once, so
copies of a text cannot pull it.  Distances, thresholds and moments are grouped
aggregations with partial sums, so a large source is spread over all tasks.  A
document is rejected when its final distance passes the chi-squared limit.

Groups below ``LEAST`` documents share a model per language, and if these are
still below it, one model.  Scatter has a floor per statistic, so statistics
that hardly vary in a group do not turn small differences into outliers.

Defined results: a null text has no words and fails the base rule; null
languages and sources are groups of their own; repeated rows are rows of their
own and count each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, chunks, cut, ship, table
from .wordhash import ngrams, split_bytes, text_bytes, word_hashes

WINDOW = 5
LEAST = 50
#: Concentration steps end when no determinant falls, after these at the latest.
STEPS = 30
CORE = 0.5
STARTS = ("deviations", "tanh", "signs")
# Chi-squared figures for 5 statistics: the consistency factors of the half and
# of what the 97.5% quantile holds (the share over that of a 7-degree variable
# below the same limit), that quantile, and the 0.99999 quantile.
CONSISTENCY = 1.91221
REWEIGHED_TO = 12.8325
REWEIGHED_CONSISTENCY = 1.05553
LIMIT = 30.8562
FEATURES = ("f_words", "f_length", "f_symbols", "f_lines", "f_repeats")
#: Least standard deviation of a transformed statistic.
FLOOR = (0.5, 0.2, 0.05, 0.7, 0.1)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeat_words(doc: np.ndarray, h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words in windows found twice or more in their text."""
    n = len(first) - 1
    if not len(h):
        return np.zeros(n, np.int64)
    order = np.lexsort((h, doc))
    d, g = doc[order], h[order]
    same = (d[1:] == d[:-1]) & (g[1:] == g[:-1])
    twice = np.zeros(len(h), bool)
    twice[1:] |= same
    twice[:-1] |= same
    # a text's windows begin at its first words, one after the other
    begin = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1])
    length = np.diff(np.concatenate([begin, [len(doc)]]))
    at = first[doc] + np.arange(len(doc)) - np.repeat(begin, length)
    marks = np.zeros(first[-1] + 1, np.int64)
    hits = at[order[twice]]
    np.add.at(marks, hits, 1)
    np.add.at(marks, hits + WINDOW, -1)
    return _per_text(np.cumsum(marks)[:-1] > 0, first)


def _dup_lines(data: np.ndarray, offsets: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    raw, out = data.tobytes(), np.zeros(len(offsets) - 1, np.int64)
    for i in np.flatnonzero(words):
        seen = set()
        for line in raw[offsets[i] : offsets[i + 1]].split(b"\n"):
            if line in seen:
                out[i] += bool(line.strip(b" \t\n\x0b\x0c\r"))
            else:
                seen.add(line)
    return out


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every text, whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, offsets = text_bytes(batch.column(3))
            b = split_bytes(data, offsets)
            doc, h = ngrams(b, word_hashes(b), WINDOW, short=False)
            in_word = np.zeros(len(data) + 1, np.int64)
            np.add.at(in_word, b.start, 1)
            np.add.at(in_word, b.end, -1)
            points = (data & 0xC0) != 0x80
            counts = [
                b.n_words,
                _per_text(points & (np.cumsum(in_word)[:-1] > 0), offsets),
                _per_text(_SYMBOL[data], offsets),
                _dup_lines(data, offsets, b.n_words),
                _repeat_words(doc, h, b.first),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[pa.array(c.astype(np.int64)) for c in counts]], ["doc_id", "lang", "source", *_COUNTS])

    src = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return arrow_map(src, run, f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS))


def transformed(stats: DataFrame) -> DataFrame:
    """The statistics on scales where ordinary texts vary about normally."""

    def share(a: str, b: str) -> Column:  # variance-stabilised
        return F.asin(F.sqrt(F.least(F.col(a) / F.greatest(F.col(b), F.lit(1)), F.lit(1.0))))

    return stats.withColumns(
        {
            "f_words": F.log1p("n_words"),
            "f_length": F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)),
            "f_symbols": share("n_symbols", "word_chars"),
            "f_lines": F.log1p("n_dup_lines"),
            "f_repeats": share("n_repeat_words", "n_words"),
        }
    )


def with_model(rows: DataFrame) -> DataFrame:
    """``rows`` with ``model``: their language and source, or what they share."""
    per = cut(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "groups")
    few = per.where(F.col("n") < LEAST).groupBy(F.col("lang").alias("__l")).agg(F.sum("n").alias("in_lang"))
    own = F.concat_ws("\u0001", F.lit("s"), F.coalesce(F.col("lang"), F.lit("\u0002")), F.coalesce(F.col("source"), F.lit("\u0002")))
    lang = F.concat_ws("\u0001", F.lit("l"), F.coalesce(F.col("lang"), F.lit("\u0002")))
    named = per.join(few, F.col("lang").eqNullSafe(F.col("__l")), "left").select(
        F.col("lang").alias("__lang"), F.col("source").alias("__source"),
        F.when(F.col("n") >= LEAST, own).when(F.col("in_lang") >= LEAST, lang).otherwise(F.lit("a")).alias("model"),
    )
    named = cut(named, "models")
    j = rows.join(named, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")))
    return j.drop("__lang", "__source")


def _inverted(consistency: float):
    """centre, inverse scatter and its log determinant of models given by moments."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = len(FEATURES)
        for frame in frames:
            rows = []
            for name, n, sums, products in zip(frame["model"], frame["n"], frame["sums"], frame["products"], strict=True):
                centre = np.asarray(sums, float) / n
                scatter = np.asarray(products, float).reshape(k, k) / n - np.outer(centre, centre)
                scatter = _floored(consistency * (scatter + scatter.T) / 2)
                rows.append((name, centre.tolist(), np.linalg.inv(scatter).ravel().tolist(), float(np.linalg.slogdet(scatter)[1])))
            yield pd.DataFrame(rows, columns=["model", "centre", "inverse", "logdet"])

    return run


_MODEL = "model string, centre array<double>, inverse array<double>, logdet double"


def _floored(scatter: np.ndarray) -> np.ndarray:
    """Scatter with no direction narrower than the floors (in their scale)."""
    floor = np.asarray(FLOOR)
    unit = scatter / np.outer(floor, floor)
    values, vectors = np.linalg.eigh(unit)
    return (vectors * np.maximum(values, 1.0)) @ vectors.T * np.outer(floor, floor)


def _distance() -> Column:
    k, total = len(FEATURES), F.lit(0.0)
    off = [F.col(f) - F.col("centre")[i] for i, f in enumerate(FEATURES)]
    for i in range(k):
        for j in range(i, k):
            term = off[i] * off[j] * F.col("inverse")[i * k + j]
            total = total + (term if i == j else term * 2)
    return total


def _measured(rows: DataFrame, models: DataFrame) -> DataFrame:
    m = models.withColumnRenamed("model", "__model")
    return rows.join(m, F.col("model") == F.col("__model")).withColumn("d2", _distance()).drop("__model", "centre", "inverse", "logdet")


def _from(core: DataFrame, consistency: float) -> DataFrame:
    """The models given by the rows of ``core``."""
    moments = core.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(f) for f in FEATURES]).alias("sums"),
        F.array(*[F.sum(F.col(a) * F.col(b)) for a in FEATURES for b in FEATURES]).alias("products"),
    )
    return moments.mapInPandas(_inverted(consistency), _MODEL)


def _started(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A model per start, named model and start."""
    k = len(FEATURES)
    for frame in frames:
        rows = []
        for name, centre, deviation, tanh, signs in zip(*[frame[c] for c in ("model", "centre", "deviation", "tanh", "signs")], strict=True):
            scale = np.asarray(deviation, float)
            for start, shape in zip(STARTS, (np.eye(k).ravel(), tanh, signs), strict=True):
                shape = np.asarray(shape, float).reshape(k, k)
                width = np.sqrt(np.diag(shape))
                shape = shape / np.outer(width, width) if (width > 1e-9).all() else np.eye(k)
                scatter = _floored(shape * np.outer(scale, scale))
                rows.append((f"{name}\u0001{start}", list(centre), np.linalg.inv(scatter).ravel().tolist(), float("inf")))
        yield pd.DataFrame(rows, columns=["model", "centre", "inverse", "logdet"])


def starts(rows: DataFrame) -> DataFrame:
    k = len(FEATURES)
    accuracy = F.lit(1000)
    mid = cut(rows.groupBy("model").agg(*[F.percentile_approx(f, 0.5, accuracy).alias(f"m_{f}") for f in FEATURES]), "medians")
    off = rows.join(mid.withColumnRenamed("model", "__model"), F.col("model") == F.col("__model")).drop("__model")
    spread = off.groupBy("model").agg(*[F.percentile_approx(F.abs(F.col(f) - F.col(f"m_{f}")), 0.5, accuracy).alias(f"s_{f}") for f in FEATURES])
    spread = cut(spread.select(F.col("model").alias("__model"), *[F.greatest(F.col(f"s_{f}") * 1.4826, F.lit(floor)).alias(f"s_{f}") for f, floor in zip(FEATURES, FLOOR, strict=True)]), "deviations")
    z = off.join(spread, F.col("model") == F.col("__model")).withColumns({f"z_{f}": (F.col(f) - F.col(f"m_{f}")) / F.col(f"s_{f}") for f in FEATURES})
    z = z.withColumn("norm", F.sqrt(sum((F.col(f"z_{f}") * F.col(f"z_{f}") for f in FEATURES), F.lit(0.0))))

    def products(of) -> Column:
        return F.array(*[F.avg(of(a) * of(b)) for a in FEATURES for b in FEATURES])

    of = z.groupBy("model").agg(
        F.array(*[F.first(f"m_{f}") for f in FEATURES]).alias("centre"),
        F.array(*[F.first(f"s_{f}") for f in FEATURES]).alias("deviation"),
        products(lambda f: F.tanh(f"z_{f}")).alias("tanh"),
        products(lambda f: F.when(F.col("norm") > 0, F.col(f"z_{f}") / F.col("norm")).otherwise(0.0)).alias("signs"),
    )
    return of.mapInPandas(_started, _MODEL)


def fit(rows: DataFrame) -> DataFrame:
    """model, centre, inverse: the estimates of every model over all ``rows``,
    equal vectors once."""
    ship(rows.sparkSession)
    rows = cut(rows.select("model", *FEATURES).distinct(), "distinct")
    best = cut(starts(rows), "starts")
    each = rows.withColumn("model", F.explode(F.array(*[F.concat("model", F.lit(f"\u0001{start}")) for start in STARTS])))
    for step in range(STEPS):
        measured = _measured(each, best)
        reach = cut(measured.groupBy(F.col("model").alias("__m")).agg(F.percentile_approx("d2", CORE, F.lit(10_000)).alias("reach")), "reach")
        core = measured.join(reach, F.col("model") == F.col("__m")).where(F.col("d2") <= F.col("reach"))
        new = _from(core, CONSISTENCY)
        old = best.select(F.col("model").alias("__model"), F.struct("centre", "inverse", "logdet").alias("old"))
        falls = F.col("logdet") < F.col("old.logdet") - 1e-6
        both = new.join(old, F.col("model") == F.col("__model"))
        kept = [F.when(falls, F.col(c)).otherwise(F.col(f"old.{c}")).alias(c) for c in ("centre", "inverse", "logdet")]
        stepped = cut(both.select("model", *kept, falls.alias("fell")), f"model{step}")
        best = stepped.drop("fell")
        if stepped.where("fell").isEmpty():
            break
    name = F.regexp_replace("model", "\u0001[a-z]+$", "").alias("model")
    raw = best.groupBy(name).agg(F.min(F.struct("logdet", "model", "centre", "inverse")).alias("b"))
    raw = cut(raw.select("model", "b.centre", "b.inverse", "b.logdet"), "raw")
    return cut(_from(_measured(rows, raw).where(F.col("d2") <= REWEIGHED_TO), REWEIGHED_CONSISTENCY), "model")


def judge_quality(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and distance (squared; null where
    the base rule failed) of every row of ``docs``."""
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    stats = cut(text_statistics(docs).withColumn("base_failed", failed), "statistics")
    rest = cut(with_model(transformed(stats.where("NOT base_failed"))), "vectors")
    good = _measured(rest, fit(rest)).select("doc_id", *_COUNTS, "base_failed", (F.col("d2") <= LIMIT).alias("kept"), F.col("d2").alias("distance"))
    bad = stats.where("base_failed").select("doc_id", *_COUNTS, "base_failed", F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return good.unionByName(bad)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))
