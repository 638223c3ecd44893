"""Search, collocations and the trie against brute force, and on null, empty, tied,
repeated, very long and oddly typed rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from larchmart.llm import collocations, topk, trie

# -- search ------------------------------------------------------------------


def _nearest(rows, k, step):
    fine = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {(i, tuple(v)) for i, v in fine if i % step == 0}
    out = []
    for i, v in asked:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in fine if j != i and len(w) == len(v))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def _vectors(n, dim, seed, scale=1.0):
    rnd = random.Random(seed)
    return [(i, [scale * rnd.gauss(0, 0.2) for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("tiles", [(2048, 8192, 256, 16), (3, 7, 2, 2)])
def test_search_equals_brute_force(spark, monkeypatch, tiles):
    for name, value in zip(("TILE_QUERIES", "TILE_ROWS", "SLICE", "FAN_IN"), tiles, strict=True):
        monkeypatch.setattr(topk, name, value)
    rows = _vectors(60, 6, 1) + [(100 + i, [0.5] * 6) for i in range(25)]  # a vector that many rows share
    rows += [(200, None), (201, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (220, [float("nan")] * 6), (240, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [(260, []), (261, []), (280, [1.0, -1.0]), (281, [1.0, 2.0]), (300, [0.25] * 6), (300, [0.25] * 6), (7, [0.5] * 6), (-20, [0.1] * 6)]
    df = spark.createDataFrame([(*r, "x", 5, 6) for r in rows], "vec_id long, embedding array<double>, id string, block int, shard int").repartition(3)
    got = topk.search(df.where("vec_id % 20 = 0"), df, 4, scale=64.0)
    assert sorted(map(tuple, got.collect())) == _nearest(rows, 4, 20)
    assert topk.search(df.limit(0), df, 4, scale=64.0).count() == 0
    assert topk.search(df.where("vec_id = 20"), df.limit(0), 4, scale=64.0).count() == 0


@pytest.mark.parametrize("scale", [1e6, 1e16])
def test_search_is_exact_beyond_double_and_64_bits(spark, scale):
    """Products beyond 2**53 are exact, beyond 64 bits they end at the limits."""
    rows = _vectors(30, 3, 2, scale)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.search(df.where("vec_id % 10 = 0"), df, 5, scale=64.0).collect()]
    limit = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    fine = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    for i, v in fine[::10]:
        want = sorted((-limit(sum(a * b for a, b in zip(v, w))), j) for j, w in fine if j != i)[:5]
        assert sorted(r[1:] for r in got if r[0] == i) == [(n + 1, j, -s) for n, (s, j) in enumerate(want)]


# -- collocations ------------------------------------------------------------


def _collocations(rows, threshold, top):
    f, n = Counter(), Counter()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    frequent = {k: v for k, v in f.items() if v >= threshold}
    most = Counter()
    for (lang, p), a in frequent.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                most[lang, p[i : i + size]] = max(most[lang, p[i : i + size]], a)
    out = []
    for (lang, p), a in frequent.items():
        if len(p) > 1 and 100 * most[lang, p] < 80 * a:
            score, _, left, right = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.append((lang, -score, -a, " ".join(p).encode(), left, right))
    rank, result = Counter(), []
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


def _prose():
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 4))) for _ in range(60)]
    phrase = lambda: rnd.choice(["new york city", "New York", "a b c d e", rnd.choice(words), rnd.choice(words)])
    texts = [rnd.choice([" ", "  ", "\t"]).join(phrase() for _ in range(rnd.randint(1, 40))) + rnd.choice([".", ", and so", "\n", ""]) for _ in range(200)]
    rows = [(t, rnd.choice(["en", "de", None, "", "und"])) for t in texts]
    return rows + rows[:30] * 3 + [(None, "en"), ("", None), (" \t. ,\n", "en"), ("one", "xx"), ("x" * 50_000 + " ok", "en"), ("to be or not " * 5_000, "en"), ("A B ok.no", "fr")]


@pytest.mark.parametrize(("shards", "slots"), [(3, 1 << 16), (4, 4), (7, 64)])
def test_collocations_equal_brute_force(spark, shards, slots):
    """Also where almost every phrase shares its slots with others."""
    rows = _prose()
    df = spark.createDataFrame([(i, *r, 1, "w") for i, r in enumerate(rows)], "doc_id long, text string, lang string, n int, words string").repartition(5)
    got = collocations.best_collocations(df, 40, threshold=6, shards=shards, slots=slots)
    assert sorted(map(tuple, got.collect())) == _collocations(rows, 6, 40)


def test_counts_of_all_frequent_phrases(spark):
    rows = _prose()
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    frequent, totals = collocations.frequent_phrases(df, 10, shards=2)
    got = {(r["lang"], r["phrase"]): r["n"] for r in frequent.collect()}
    assert got[("en", "to be or not")] == 5_000 and got[("en", "not to be or")] == 4_999
    assert all(n >= 10 for n in got.values())
    assert sum(r["n"] for r in totals.collect()) == sum(len(re.findall(r"[^ \t.,;:!?\n-\r]+", t or "")) for t, _ in rows)


def test_collocations_of_an_empty_table(spark):
    df = spark.createDataFrame([], "text string, lang string")
    got = collocations.best_collocations(df, 5)
    assert got.count() == 0 and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_large_counts_do_not_overflow(spark, monkeypatch):
    """2,000,000 times a count passes 64 bits."""
    big = 8_000_000_000_000
    frequent = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big)], "lang string, len int, phrase string, n long")
    totals = spark.createDataFrame([("en", 2 * big + 1)], "lang string, n long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a, **k: (frequent, totals))
    row = collocations.best_collocations(frequent, 5).first()
    assert (row["score"], row["l"], row["r"], row["n"]) == (2_000_000 * big // (2 * big + 1), big, big + 1, 2 * big + 1)


# -- trie --------------------------------------------------------------------


def _trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        seq = turns.get(c - c % 100, [])[:h] + turns[c][h:]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []

    def walk(p):
        below = [walk(q) for q in children[p]]
        leaves = sum(x[0] for x in below) or 1
        saved = sum(x[1] for x in below) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
        sha = hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()
        out.append((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(below), leaves, saved, sha))
        return leaves, saved

    if members:
        walk(())
    return sorted(out)


def _talk():
    rnd = random.Random(3)
    say = lambda: (rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "é😀", "", None, "x" * 300 + str(rnd.randint(0, 2)), "bye"]))
    rows = []
    for c in [*range(0, 60), *range(100, 140), *range(205, 240), 5_000_000_123]:
        first = rnd.choice([0, 1, 2, 3])
        rows += [(c, t if t else None, *((("user", "hello there") if t < first else say()))) for t in range(rnd.choice([1, 2, 4, 9]))]
    rows += [(300, t, "user", "long") for t in range(150)] + [(c, t, "user", "long") for c in (301, 302) for t in range(150)] + [(303, 1, "user", "long")] * 40
    return rows + [(None, 1, "user", "lost"), rows[3], rows[3], rows[10]]


@pytest.mark.parametrize("width", [None, 64])
def test_trie_equals_brute_force(spark, width):
    """With and without a sketch that is wide enough to prove anything unique."""
    rows = _talk()
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, place string, d1 int").repartition(4)
    got = trie.prefix_trie(*trie.rebuilt(df), width=width)
    assert sorted(map(tuple, got.collect())) == _trie(rows)


def test_screening_proves_only_unique_digests(spark):
    rows = _talk()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = trie.prefixes(trie.rebuilt(df)[1]).cache()
    counts = found.groupBy("d1", "d2").count()
    for width in (64, 1 << 16):
        flagged = trie.screened(found, width).join(counts, ["d1", "d2"])
        assert flagged.where("alone AND count > 1").count() == 0
        if width > 64:
            assert flagged.where("alone").count() > 0.9 * flagged.where("count = 1").count() > 0


def test_trie_of_an_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.prefix_trie(*trie.rebuilt(df)).count() == 0


def test_trie_without_turns_left(spark):
    """Every conversation lost its turns: the root is the only node and a leaf."""
    c = next(x for x in range(1, 99) if zlib.crc32(str(x).encode()) % 6 >= 2)
    rows = [(c, 0, "user", "gone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in trie.prefix_trie(*trie.rebuilt(df)).collect()] == _trie(rows)


def test_running_aggregates_cross_slices(spark):
    """One key holds almost all rows and so goes over every slice."""
    df = spark.range(2000).select(F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(7).alias("k"), F.col("id").alias("at"))
    got = trie.running(df, "k", [F.col("at")], {"n": (F.sum, F.lit(1).cast("long")), "x": (F.bit_xor, F.col("at"))}, ["k", "at"], "test").collect()
    seen, x = Counter(), Counter()
    for r in sorted(got, key=lambda r: r["at"]):
        seen[r["k"]] += 1
        x[r["k"]] ^= r["at"]
        assert (r["n"], r["x"]) == (seen[r["k"]], x[r["k"]])
    assert len(got) == 2000
