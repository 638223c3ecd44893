"""The corpus operators against brute force, and on empty, null, tied and
repeated rows, very long texts and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larchmart.llm import extraction, fingerprints, mixing, ngram_join, packing, pii, quality, sharding, toxicity, warc
from larchmart.llm.common import shared_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, pii string, size long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _texts():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeéñ") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.choice([3, 12, 60, 300]))) for _ in range(60)]
    near = [t.replace(" a", " b", 1) + " Zz" for t in base[:20]]
    odd = ["", None, "one", "two words", " \n\t ", "😀 é " * 30, "x" * 30000, "7" * 20000, "ab " * 9000, "AbC def GHI jkl", "abc DEF ghi JKL"]
    pii_text = ["mail a.b@c.de or (x@y), 10.0.0.255 256.1.1.1, 4111 1111 1111 1111, +49 (0)30 1234567 IBAN DE89 3704 0044 0532 0130 00 ssn 078-05-1120", "a@b.c%x@d.e +1234567890123456"]
    return base + near + base[:5] * 3 + odd + pii_text


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None, "s1"][i % 4], None, 1.5, "p", 3) for i, t in enumerate(_texts())]
    rows += [rows[3], rows[3], (None, "no id here at all", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def _rows(df):
    return [r.asDict() for r in df.collect()]


def test_mixing_reaches_targets_and_reruns_agree(docs, empty):
    plan = _rows(mixing.mix_plan(docs, fan_in=8))
    again = _rows(mixing.mix_plan(docs, fan_in=8))
    key = lambda r: (str(r["doc_id"]), r["size"], r["copies"])
    assert sorted(map(key, plan)) == sorted(map(key, again))
    assert sum(r["rows"] for r in plan) == docs.count()
    per = defaultdict(lambda: [0, 0, None])
    for r in plan:
        assert 0 <= r["copies"] <= 3
        p = per[r["source"]]
        p[0] += r["size"] * r["rows"]
        p[1] += r["size"] * r["rows"] * r["copies"]
        p[2] = (r["source_size"], r["target"])
    for size, taken, (stated, target) in per.values():
        assert size == stated and target <= 3 * size + 1e-6 and abs(taken - target) <= max(0.05 * target, 20)
    assert abs(sum(p[2][1] for p in per.values()) - sum(p[0] for p in per.values())) < 1e-6
    assert mixing.mix_plan(empty).count() == 0
    mixed = mixing.mix_sources(docs, fan_in=8)
    assert [c for c in mixed.columns] == docs.columns and mixed.count() == sum(r["rows"] * r["copies"] for r in plan if r["size"] or r["copies"])


def test_mixing_of_a_third_of_rows_under_one_id(spark):
    """Equal rows are dealt one by one: a source that is mostly one repeated row keeps its target."""
    rows = [(1, "a b c d e f g", "s1", 1)] * 1500 + [(2, None, "s2", 1)] * 5 + [(i, "w " * (i % 9), f"s{1 + i % 3}", 1) for i in range(10, 1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(5)
    plan = _rows(mixing.mix_plan(docs))
    assert sum(r["rows"] for r in plan) == len(rows)
    taken = Counter()
    for r in plan:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["rows"] * r["copies"]
    targets = {r["source"]: r["target"] for r in plan}
    assert all(abs(taken[s] - t) <= 9 for s, t in targets.items())
    assert mixing.each_row(mixing.mix_plan(docs)).count() == len(rows)
    mixed = Counter(r["doc_id"] for r in _rows(mixing.mix_sources(docs)))
    want = Counter()
    for r in plan:
        want[r["doc_id"]] += r["rows"] * r["copies"]
    assert mixed == +want


def test_rows_that_repeat_very_often_are_dealt_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS", 7)
    plan = spark.createDataFrame([(1, 50, 2), (2, 7, 1), (3, 1, 0)], "doc_id long, rows long, copies long")
    assert Counter(r["doc_id"] for r in _rows(mixing.each_row(plan))) == {1: 50, 2: 7, 3: 1}


def test_targets_are_water_filled(spark):
    sized = spark.createDataFrame([("a", 10, 1), ("b", 1000, 1), ("c", 90, 1), (None, 100, 1)], "source string, size long, rows long")
    got = {r["source"]: r["target"] for r in _rows(mixing.source_targets(sized))}
    # weights 5, 2, 1, 5: a is capped at 30, the rest is reshared, then null is capped at 300 and c at 270
    assert got["a"] == 30 and abs(sum(got.values()) - 1200) < 1e-6 and got[None] == 300


def test_warc_round_trip(spark):
    long = "é€😀" * 3000
    pages = [(5, "u", "x" * 200), (3, "u \n", "x" * 200), (9, None, "x" * 200), (7, "u", None), (8, "u", "ab"), (10, "u", "ab"), (11, "u", long)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, payload string")
    folder = shared_path(spark, "test-warc")
    warc.write_archives(df, folder, segment_bytes=1000, records_per_file=3)
    got = {r["page_id"]: r for r in _rows(warc.read_archives(spark, folder))}
    assert len(got) == len(pages) and all(r["complete"] for r in got.values())
    for page_id, _, html in pages:
        r, payload = got[str(page_id)], (html or "").encode()
        assert r["digest"] == hashlib.sha256(payload).hexdigest()
        if len(payload) >= 100 and page_id in (5, 9):
            assert r["record_type"] == "revisit" and r["refers_to"] == "3"
        else:
            assert r["record_type"] == "response" and bytes(r["payload"]) == payload


def test_warc_missing_segment_is_incomplete():
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"abc" * 9)
    parts = [{"segment": k + 1, "block": block[a : a + 20]} for k, a in enumerate(range(0, len(block), 20))]
    assert warc._decode(parts, len(block)) == b"abc" * 9
    for bad, total in ((parts[:-1], len(block)), (parts[1:], len(block)), (parts, len(block) + 1)):
        with pytest.raises(ValueError):
            warc._decode(bad, total)


@pytest.mark.parametrize("shards", [1, 16])
def test_sharding_by_bytes(docs, empty, shards):
    rows = _rows(sharding.shard_documents(docs, shards=shards, slots=256))
    assert len(rows) == docs.count()
    sizes, places = Counter(), defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    texts = {r["doc_id"]: r["text"] or "" for r in _rows(docs)}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
    assert max(sizes.values()) <= sum(sizes.values()) / shards + max(r["size"] for r in rows)
    assert sharding.shard_documents(empty).count() == 0


@pytest.mark.parametrize("text", [None, "always the same"])
def test_sharding_of_a_third_of_rows_under_one_id(spark, text):
    rnd = random.Random(4)
    rows = [(0 if i % 3 == 0 else i, text if i % 3 == 0 else "x" * rnd.randint(0, 60)) for i in range(6000)]
    got = _rows(sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    sizes, places = Counter(), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert len(got) == len(rows) and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(sizes.values()) - min(sizes.values()) <= 0.05 * sum(sizes.values()) / 16
    per_slot = Counter(r["virtual_slot"] for r in got if r["doc_id"] == 0)
    assert max(per_slot.values()) <= 20


def test_a_stored_slot_map_is_read_and_edited(spark):
    folder = shared_path(spark, "test-map")
    docs = spark.createDataFrame([(i, "x" * (i * 7 % 90)) for i in range(3000)], "doc_id long, text string").repartition(3)
    first = {(r["doc_id"]): r for r in _rows(sharding.shard_documents(docs, 8, 256, folder))}
    second = {(r["doc_id"]): r for r in _rows(sharding.shard_documents(docs, 8, 256, folder))}
    assert len(second) == 3000 and {r["map_version"] for r in first.values()} == {1} and {r["map_version"] for r in second.values()} == {2}
    assert sum(first[i]["shard"] != second[i]["shard"] for i in first) < 3000 / 10
    fewer = _rows(sharding.shard_documents(docs, 5, 256, folder))
    sizes = Counter()
    for r in fewer:
        sizes[r["shard"]] += r["size"]
    assert len(fewer) == 3000 and set(sizes) == set(range(5)) and max(sizes.values()) <= 1.1 * sum(sizes.values()) / 5
    with pytest.raises(ValueError):
        sharding.shard_documents(docs, 5, 128, folder)


def test_slot_map_edit_moves_little(spark):
    first = sharding.first_map(spark, 64, 4)
    even = spark.range(64).selectExpr("id as virtual_slot", "10L as bytes", "1L as n_rows")
    assert sharding.rebalance(first, even, 4).join(first.select("virtual_slot", "shard"), ["virtual_slot", "shard"]).count() == 64


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def _valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.split(".")), "card": 13 <= len(d) <= 19 and _luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def test_pii_spans_against_brute_force(docs, empty):
    found = _rows(pii.find_pii(docs))
    assert len(found) == docs.count()
    for r in found:
        text = r["text"] or ""
        want = [(k, m.start(), m.end()) for k, p in BASE.items() if len(text) < 20000 or k != "email" for m in re.finditer(p, text) if _valid(k, m[0])]
        assert [(s["kind"], s["start"], s["end"]) for s in r["pii"] if s["kind"] in BASE] == want
    assert pii.find_pii(empty).count() == 0
    masked = {r["doc_id"]: r["text"] for r in _rows(pii.mask_pii(pii.find_pii(docs)))}
    text = next(t for t in masked.values() if t and t.startswith("mail"))
    assert text == "mail [EMAIL] or (x@y), [IP] 256.1.1.1, [CARD], [PHONE] IBAN [IBAN] ssn [SSN]"


@pytest.mark.parametrize("number", ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"])
def test_pii_finds_account_numbers_before_capitals_and_amounts(spark, number):
    tails = ["", " Deutsche Bank", " Please", " BIC COBADEFFXXX", " EUR 100", " 100 EUR", " A", " and", ".", "X", "\n12"]
    texts = [f"REF12 pay {number}{t}" for t in tails] + [f"DE12 {number} GB12"]
    found = {r["doc_id"]: r for r in _rows(pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))}
    for i, text in enumerate(texts):
        at = text.index(number, 5)
        want = [] if text.endswith("X") and not text.endswith("FXXX") else [(at, at + len(number))]
        assert [(s["start"], s["end"]) for s in found[i]["pii"] if s["kind"] == "iban"] == want


def test_extraction_keeps_the_article_only(spark):
    html = """<html><head><title>t</title><script>var a="</p>";</script></head><body class="has-sidebar"><header>Site</header><nav><a>x</a></nav>
    <div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><article><header><h1>Head &amp;\n line</h1></header><p><b>First &eacute;<br> para<p>Two.
    <aside>side</aside></p><form><input> send</form><p>Short</p><div class="comments"><p>Nice</p></div></article><footer>end</footer></body></html>"""
    rows = [(1, "u", html), (2, "u", None), (3, None, ""), (4, "u", "<p>unclosed <b>bold"), (5, "u", "plain " * 20000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in _rows(extraction.extract_main_text(df))}
    assert got[1]["text"] == "Head & line\nFirst é para\nTwo.\nShort"
    assert (got[2]["text"], got[3]["text"], got[4]["text"]) == ("", "", "unclosed bold")
    assert got[5]["n_chars"] == len(("plain " * 20000).strip())


@pytest.mark.parametrize("tag", ["div", "section"])
def test_extraction_keeps_all_sections_without_an_article(tag):
    part = lambda name, n: "".join(f"<p>{name} {k} " + "some words of the text " * 8 + "</p>" for k in range(n))
    html = f"""<html><body><div class="nav"><a>Home</a><a>News</a></div><div><h1>The heading</h1><p>{"An introduction of some length. " * 5}</p>
    <{tag}><h2>First</h2>{part("big", 12)}</{tag}><{tag}><h2>Second</h2>{part("small", 8)}</{tag}></div><div>{"<p><a>More</a></p>" * 12}</div><footer>end</footer></body></html>"""
    lines = extraction.main_text(html).split("\n")
    assert lines[0] == "The heading" and lines[1].startswith("An introduction") and {"First", "Second"} <= set(lines)
    assert sum(line.startswith(("big", "small")) for line in lines) == 20 and not {"Home", "More", "end"} & set(lines)


def _shingles(text, n, lower=False):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text
    w = WORD.findall(text)
    return set(zip(*[w[i:] for i in range(n)], strict=False)) if len(w) >= n else {tuple(w)} if w else set()


@pytest.mark.parametrize(
    "broken", ["<a " * 350_000, "<!--" * 250_000, "</a " * 250_000, "<?x" * 300_000, "<div>" * 200_000 + "</div>" * 200_000, "<b>" * 150_000 + "</i>" * 150_000, "<p>" + "<b>" * 150_000]
)
def test_extraction_is_linear_on_broken_and_deep_pages(broken):
    import time

    article = "<article><p>" + "Some words here. " * 40 + "</p></article>"
    begin = time.time()
    assert extraction.main_text(article + broken) == " ".join(["Some words here."] * 40)
    assert time.time() - begin < 30


def test_extraction_of_repeated_odd_and_no_rows(spark):
    html = "<article><p>a&amp;b</p><p>c <!-- x --> d<!-- never closed"
    rows = [(1, "u", html, "t"), (1, "u", html, "t"), (2, None, None, "t"), (None, "v", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in _rows(extraction.extract_main_text(pages)))
    assert got == [("1", "a&b\nc d", 7), ("1", "a&b\nc d", 7), ("2", "", 0), ("None", "", 0)]
    assert extraction.extract_main_text(pages.limit(0)).count() == 0


def test_fingerprints_against_exact_sets(docs, empty):
    got = _rows(fingerprints.fingerprint_documents(docs))
    assert len(got) == docs.count() and fingerprints.fingerprint_documents(empty).count() == 0
    order = sorted((r for r in _rows(docs) if r["doc_id"] is not None), key=lambda r: -r["doc_id"])
    order += [r for r in _rows(docs) if r["doc_id"] is None]
    by = {r["doc_id"]: r for r in got}
    prints = defaultdict(set)
    for r, nxt in zip(order, order[1:] + order[:1], strict=True):
        if r["doc_id"] == 3:  # repeated rows
            continue
        a, b, g = r["text"] or "", nxt["text"] or "", by[r["doc_id"]]
        half = len(a) // 2
        edited = a[: len(a) - half] + b[:half]
        assert g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and g["n_chars"] == len(a)
        x, y = _shingles(a, 5), _shingles(edited, 5)
        true = len(x & y) / len(x | y) if x | y else 1.0
        assert abs(g["near_edited"] - true) < 0.2
        prints[a].add(bytes(g["fingerprint"]))
    assert all(len(p) == 1 for p in prints.values())


def test_quality_counts_and_verdict(docs, empty):
    got = _rows(quality.judge_quality(docs))
    assert len(got) == docs.count() and quality.judge_quality(empty).count() == 0
    texts = {r["doc_id"]: r["text"] or "" for r in _rows(docs)}
    for r in got:
        text = texts[r["doc_id"]]
        w = WORD.findall(text)
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        count = Counter(grams)
        covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 5)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            dup += bool(WORD.search(line)) and line in seen
            seen.add(line)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
        )
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r["base_failed"] and r["kept"])


def test_quality_rejects_an_outlier(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(rnd.randint(2, 8)))
    rows = [(i, " ".join(word() for _ in range(rnd.randint(50, 400))), "en", "s") for i in range(150)]
    rows.append((999, " ".join(word() + "###" for _ in range(100)), "en", "s"))
    got = {r["doc_id"]: r["kept"] for r in _rows(quality.judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))}
    assert not got.pop(999) and all(got.values())


@pytest.mark.parametrize("alike", [True, False])
def test_quality_rejects_a_third_of_junk(spark, alike):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(rnd.randint(2, 8)))
    text = lambda tail: " ".join(word() + tail for _ in range(rnd.randint(50, 400)))
    copy = text("###")
    rows = [(i, text(""), "en", "s") for i in range(132)] + [(1000 + i, copy if alike else text("###"), "en", "s") for i in range(68)]
    got = {r["doc_id"]: r["kept"] for r in _rows(quality.judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))}
    assert not any(kept for i, kept in got.items() if i >= 1000) and sum(not kept for i, kept in got.items() if i < 1000) <= 1


def test_fast_ids_only_of_files_that_prove_them(tmp_path):
    import json

    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encode = packing.Encoder(path)
    assert encode.fast is not None
    rnd, pool = random.Random(1), " \t\n  \u3000\u00a0\u0085\u200b'sdtlvemr.é1٣ñ中😀\u0301a\0Ÿ×"
    for n in range(3000):
        text = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 25)))
        assert encode(text) == encode._exact(text)
    spec = json.load(open(path, encoding="utf-8"))
    first, second = spec["model"]["merges"][:2]
    changes = [
        {"normalizer": {"type": "NFC"}},
        {"pre_tokenizer": {**spec["pre_tokenizer"], "add_prefix_space": True}},
        {"pre_tokenizer": {**spec["pre_tokenizer"], "use_regex": False}},
        {"model": {**spec["model"], "merges": [second, first, *spec["model"]["merges"][2:]]}},
        {"model": {**spec["model"], "merges": spec["model"]["merges"][:-1]}},
    ]
    for k, change in enumerate(changes):
        other = tmp_path / f"{k}.json"
        other.write_text(json.dumps({**spec, **change}), encoding="utf-8")
        encode = packing.Encoder(str(other))
        assert encode.fast is None and encode("ab  c\u0301") == encode._exact("ab  c\u0301")


def test_packing_round_trip(spark, docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = spark.createDataFrame([(9001, "a<|endoftext|>b \t\n  c  d")], "doc_id long, text string")
    src = docs.select("doc_id", "text").unionByName(special)
    rows = _rows(packing.pack_documents(src, capacity=64))
    per, seq = defaultdict(list), defaultdict(list)
    for r in rows:
        per[r["doc_id"]].append(r)
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for r in _rows(src.where("doc_id <> 3 OR doc_id IS NULL")):
        ids = np.asarray([*exact.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(per[r["doc_id"]], key=lambda p: p["piece"])
        assert [p["length"] for p in pieces[1:]] == [64] * (len(pieces) - 1) and sum(p["length"] for p in pieces) == len(ids)
        assert all(zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for p in pieces)
    for places in seq.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    assert len(per[3]) % 3 == 0  # every repeated row is packed
    assert packing.pack_documents(empty).count() == 0


def test_best_fit_rounds_are_near_the_bound():
    rnd = np.random.default_rng(3)
    for low, high in ((1, 63), (1, 8), (30, 40), (33, 63)):
        lengths = rnd.integers(low, high + 1, 3000)
        values, counts = np.unique(lengths, return_counts=True)
        load, placed = Counter(), Counter()
        for ln, a, b, first, offset in packing.plan_rounds(values[::-1], counts[::-1], 64):
            placed[ln] += b - a
            for s in range(first, first + b - a):
                assert load[s] == offset
                load[s] += ln
        assert placed == Counter(dict(zip(values.tolist(), counts.tolist(), strict=True))) and max(load.values()) <= 64
        assert len(load) <= 1.25 * max(-(-lengths.sum() // 64), (lengths > 32).sum()) + 1


@pytest.mark.parametrize("block", [512, 3])
def test_ngram_join_against_brute_force(docs, empty, block):
    got = _rows(ngram_join.link_documents(docs, block))
    assert len(got) == docs.count() and ngram_join.link_documents(empty).count() == 0
    rows = [(r["doc_id"], _shingles(r["text"] or "", 3, lower=True)) for r in _rows(docs) if r["doc_id"] is not None]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(rows):
        for j, b in rows[:x]:
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    size = dict(rows)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["component_id"], r["n_shingles"]) == (find(r["doc_id"]), len(size[r["doc_id"]]))
    kept = _rows(ngram_join.keep_one(docs))
    assert len([r for r in kept if r["doc_id"] is None]) == 1 and ngram_join.keep_one(empty).count() == 0
    named = [r["doc_id"] for r in kept if r["doc_id"] is not None]
    assert sorted(named) == sorted(i for i in root if find(i) == i) and list(kept[0]) == docs.columns


def _passages(n):
    """Texts of 60 words; each has a passage in common with the next one, and is no copy of it."""
    rnd = random.Random(29)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(8))
    common = [[word() for _ in range(25)] for _ in range(n + 1)]
    return [" ".join([*common[k], *(word() for _ in range(10)), *common[k + 1]]) for k in range(n)]


def test_shared_passages_make_no_groups(spark):
    """What links needs many shared shingles: a chain of texts that share some is not compared all with all."""
    texts = _passages(40)
    docs = spark.createDataFrame(list(enumerate([*texts, texts[3] + " end"])), "doc_id long, text string")
    classes = ngram_join.set_classes(docs, corpus_pipeline.NEAR_COPY)
    pairs = _rows(ngram_join.rare_pairs(docs, classes, corpus_pipeline.NEAR_COPY))
    of = {r["class"]: r["doc_id"] for r in _rows(classes)}
    assert [({of[p["a"]], of[p["b"]]}, p["crowded"]) for p in pairs] == [({3, 40}, False)]


@pytest.mark.parametrize("crowd", [64, 2, 1])
def test_crowded_tiles_lose_no_link(spark, monkeypatch, crowd):
    """Counted pairs and crowded tiles find the same links, in groups beyond a block too."""
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    texts = [t for t in _passages(12) for t in (t, t + " end", t.replace(" ", " x ", 1), t + " other end")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = _rows(ngram_join.link_documents(docs, 2, corpus_pipeline.NEAR_COPY))
    assert {r["doc_id"]: r["component_id"] for r in got} == {k: k - k % 4 for k in range(len(texts))}


def test_texts_without_a_mark_stay_where_they_are(spark):
    """Only copies, and what may be one, are moved."""
    texts = _passages(40)
    docs = spark.range(0, 44, 1, 4).withColumnRenamed("id", "doc_id")
    docs = docs.withColumn("text", F.element_at(F.array(*[F.lit(t) for t in [*texts, *[texts[0]] * 4]]), (F.col("doc_id") + 1).cast("int")))
    kept = _rows(ngram_join.keep_one(docs, corpus_pipeline.NEAR_COPY).withColumn("at", F.spark_partition_id()))
    at = {r["doc_id"]: r["at"] for r in kept}
    assert sorted(at) == list(range(40))
    assert [at[i] for i in range(1, 40)] == [(at[1] + i // 11) for i in range(1, 40)]


def test_near_copy_stage_against_brute_force(spark):
    """The pipeline's stage links by five-word shingles and 0.8, whatever the size of the texts."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(3, 8))) for _ in range(600)]
    word = lambda: rnd.choice(words)
    texts, passage = ["", None, "one", "two words"], [word() for _ in range(12)]
    for k in range(160):
        n = rnd.choice([6, 9, 15, 40, 150, 700])
        base = [word() for _ in range(n)]
        if k % 4 == 0:
            base[n // 2 : n // 2] = passage  # shared by unrelated texts
        changed = [word() if rnd.random() < rnd.choice([0.01, 0.02, 0.04]) else w for w in base]
        longer, shorter = base + [word() for _ in range(int(n * rnd.uniform(0.05, 0.35)))], base[: int(n * rnd.uniform(0.7, 0.95))]
        texts += [" ".join(t) for t in rnd.sample([base, changed, longer, shorter], 3)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    sets = [_shingles(t or "", 5, lower=True) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 10 * len(a & b) >= 8 * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    want = [i for i in range(len(texts)) if find(i) == i]
    assert len(want) < len(texts) - 100
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(r["doc_id"] for r in _rows(got)) == want
    long = " ".join(words[:200])
    pair = spark.createDataFrame([(1, long), (2, long + " " + " ".join(words[200:236]))], "doc_id long, text string")
    assert [r["doc_id"] for r in _rows(corpus_pipeline.drop_near_copies(spark, pair, ""))] == [1]  # 18% appended


def _keys_of(word):
    keys = toxicity.feature_keys(pa.array([word]))[3].ravel()
    return {int(k) for k in keys.view(np.int64) if k}


def test_toxic_variants_of_a_clean_text_are_evidence(spark):
    # 30 groups of a clean text and two toxic variants of it, 60 clean texts apart
    words = iter(f"{chr(97 + i % 26)}{i}q" for i in range(10_000))
    rows, n = [], 0
    for k in range(90):
        base = " ".join(next(words) for _ in range(40))
        for bad in (["", " vilexo", " vilexo"] if k < 30 else [""]):
            rows.append((n, int(bool(bad)), base + bad))
            n += 1
    training = spark.createDataFrame(rows, "__id long, toxic int, text string").repartition(3)
    assert {r["key"] for r in _rows(toxicity.evidence(training))} == _keys_of("vilexo")
    # and the words of clean variants of a toxic text are none
    flipped = [(i, 1 if k % 3 == 0 and i < 90 else 0, t.replace(" vilexo", " mildo") + (" vilexo" if k % 3 == 0 and i < 90 else "")) for k, (i, _, t) in enumerate(rows)]
    training = spark.createDataFrame(flipped, "__id long, toxic int, text string")
    assert {r["key"] for r in _rows(toxicity.evidence(training))} == _keys_of("vilexo")
    assert toxicity.evidence(training.limit(0)).count() == 0


def test_evidence_equals_a_count_in_python(spark):
    """Stems with many forms, seen once in clean texts and often in toxic ones; copies weigh once."""
    rnd, rows = random.Random(8), []
    for i in range(400):
        w = [rnd.choice("bcdfg") + rnd.choice("aeiou") + str(rnd.randrange(300)) for _ in range(30)]
        if i % 8 == 0:
            w += ["gromenta" + rnd.choice("abcdefgh") * 3 for _ in range(4)]
        elif i % 30 == 1:
            w += ["gromentaxyz"]
        rows.append((i, int(i % 8 == 0), " ".join(w)))
    rows += [(1000 + i, 1, rows[8][2]) for i in range(50)] + [(2000, 0, ""), (2001, 1, " \n")]
    training = spark.createDataFrame(rows, "__id long, toxic int, text string").repartition(4)
    once, twice, total = ([Counter(), Counter()] for _ in range(3))
    for i, y, text in rows:
        weight = 1 / 51 if i == 8 or 1000 <= i < 2000 else 1.0
        total[y]["n"] += weight
        for key, c in Counter(int(k) for w in text.split() for k in toxicity.feature_keys(pa.array([w]))[3].ravel().view(np.int64) if k).items():
            once[y][key] += weight
            twice[y][key] += weight * (c > 1)
    n1, n0 = total[1]["n"], total[0]["n"]

    def sign(a, b):
        if a <= 1e-9:
            return False
        g2 = 2 * (a * np.log(a / ((a + b) * n1 / (n1 + n0))) + (b * np.log(b / ((a + b) * n0 / (n1 + n0))) if b else 0))
        return (a / n1) / ((b + 0.5) / n0) >= toxicity.EVIDENCE_RATIO and g2 >= toxicity.EVIDENCE_G2 and b <= toxicity.EVIDENCE_IMPURE * a

    want = {k for k in once[1] if sign(once[1][k], once[0][k]) or sign(twice[1][k], twice[0][k])}
    assert any(not sign(once[1][k], once[0][k]) for k in want)  # the stem, by its repeated forms alone
    assert {r["key"] for r in _rows(toxicity.evidence(training))} == want


def test_marginals_equal_enumeration():
    """Forward-backward marginals against the sum over all labellings."""
    from itertools import product

    rnd = np.random.default_rng(3)
    scores, trans = rnd.normal(size=9), rnd.normal(size=(2, 2))
    grid = np.array([[0, 1, 2, 3, 4, 5], [6, 7, 8, -1, -1, -1]])
    got = toxicity.marginals(scores, grid, trans)
    for chain in ([0, 1, 2, 3, 4, 5], [6, 7, 8]):
        mass, on = 0.0, np.zeros(len(chain))
        for y in product((0, 1), repeat=len(chain)):
            p = np.exp(sum(scores[t] for t, v in zip(chain, y, strict=True) if v) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False)))
            mass, on = mass + p, on + p * np.array(y)
        assert np.allclose(got[chain], on / mass)


def test_toxicity_learns_words_and_their_forms(spark):
    rnd = random.Random(2)
    clean = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 8))) for _ in range(500)]
    bad = ["grubbo", "snarf"]

    def text(toxic):
        w = [rnd.choice(clean) for _ in range(rnd.randint(20, 120))]
        for _ in range(4 if toxic else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(bad) + rnd.choice(["", "ing", "ed"]))
        return " ".join(w)

    rows = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(600)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 != 1] + [(1, None), (None, 1)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows] + [(5000, None, 0.1), (None, "", 0.1), (5001, "la le " * 20000, 0.0)], "doc_id long, text string, score double")
    got = {r["doc_id"]: r for r in _rows(toxicity.score_toxicity(docs, toxicity.fit(docs, labels)))}
    wrong = [i for i, _, y in rows if (got[i]["score"] >= 0.7) != bool(y)]
    assert len(wrong) <= 6 and max(got[i]["score"] for i in (5000, 5001, None)) < 0.3
    span = next(r for i, r in got.items() if i == 0)["toxic_spans"][0]
    assert any(got[0]["text"][span["start"] :].startswith(b) for b in bad)
    assert toxicity.score_toxicity(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in _rows(toxicity.score_toxicity(docs, none))} == {0.0}


@pytest.mark.parametrize("shape", ["path", "star", "random", "loops", "none"])
def test_components_of_any_shape(spark, shape):
    """Long paths in rising, falling and mixed order, a hub, and doubled edges."""
    rnd = random.Random(9)
    if shape == "path":
        mixed = rnd.sample(range(1000, 1060), 60)
        edges = [(i, i + 1) for i in range(60)] + [(200 - i, 199 - i) for i in range(60)] + list(zip(mixed, mixed[1:]))
    elif shape == "star":
        edges = [(500, i) for i in range(300)] + [(-5, 7)]
    elif shape == "random":
        edges = [(rnd.randrange(150), rnd.randrange(150)) for _ in range(110)]
    else:
        edges = [(1, 1), (2, 3), (3, 2), (2, 3)] if shape == "loops" else []
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["class"]: r["label"] for r in got} == label and len(got) == len(label)
