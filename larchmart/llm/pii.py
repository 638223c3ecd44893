"""Personal data: patterns propose, checksums confirm, context adjusts
(operator 4, DataFrame functions only).

Each kind has a pattern that proposes spans (leftmost, not overlapping, per
kind) and a validator that drops proposals: byte range for ip, Luhn for card,
digit count for phone, mod-97 for iban.  A span's score starts at its kind's
prior, gains for a confirming checksum and for a context word within 40 code
points; the base kinds (email, ip, card, phone) are kept whatever their score,
the added kinds (iban, ssn) from 0.5 on.

Positions come from the lengths of what lies between and inside the matches,
so no Python runs.  Patterns are possessive or anchored at the start of a run,
so a very long run of digits or letters is scanned once; an account number has
the fixed length of its country, so what follows it is never taken for a part.

Defined results: a null text is an empty text without spans; ties cannot
occur (spans of a kind do not overlap); repeated rows are rows of their own;
an empty table gives an empty result; other columns are kept, one
named like an added column is replaced by it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty, without

# The patterns of the base kinds (email, ip, card, phone), here
# with possessive repeats and, for email and ip, a start at the beginning of a
# run or right after the last match, which matches the same spans.
_LOCAL = "[A-Za-z0-9._%+-]"
# The length of the account number (iban) by country.
IBAN_LENGTH = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
    26: "IS TR IR", 27: "BF BJ BI CF CG CM DJ EG FR GA GF GP GQ KM MC MG MQ MR NC PF PM RE SM TF WF YT IT GR", 28: "AL AZ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TD TG HM",
    29: "BR PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTH.items())
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A cheap test that a text can hold the kind at all.
MAY_HOLD = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t: t.contains("+"),
    "iban": lambda t: t.rlike("[A-Z]{2}[0-9]{2}"),
    "ssn": lambda t: t.rlike("[0-9]-[0-9]{2}-[0-9]"),
}
BASE = ("email", "ip", "card", "phone")
#: Score of a proposal, and what its passed checksum or range check adds.
PRIOR = {"email": 0.6, "ip": 0.4, "card": 0.3, "phone": 0.4, "iban": 0.3, "ssn": 0.3}
CONFIRMED = {"email": 0.0, "ip": 0.2, "card": 0.4, "phone": 0.1, "iban": 0.5, "ssn": 0.0}
CONTEXT_GAIN = 0.25
CONTEXT_REACH = 40
CONTEXT = {
    "email": ["mail", "contact", "@", "correo", "courriel"],
    "ip": ["ip", "host", "server", "address", "adresse"],
    "card": ["card", "visa", "credit", "karte", "carte", "tarjeta"],
    "phone": ["phone", "tel", "call", "mobile", "fax"],
    "iban": ["iban", "bank", "account", "konto", "compte", "cuenta"],
    "ssn": ["ssn", "social", "security"],
}
KEEP_FROM = 0.5
_PREFIX_BLOCK = 256


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code (no blanks) passes the mod-97 check."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, F.lit(1), F.lit(4)))

    def add(acc: Column, ch: Column) -> Column:
        v = F.when(ch.between("0", "9"), F.ascii(ch) - 48).otherwise(F.ascii(ch) - 55)
        return F.when(v > 9, (acc * 100 + v) % 97).otherwise((acc * 10 + v) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(add(a, c))) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 2) | ((F.length(F.ltrim(p, F.lit("0"))) == 3) & (F.ltrim(p, F.lit("0")) <= "255")))
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        code = F.replace(m, F.lit(" "), F.lit(""))
        return F.when(F.length(code).between(15, 34), mod97(code)).otherwise(False)
    return F.lit(True)


def _placed(gaps: Column, found: Column) -> Column:
    """(start, m) of every match, from the pieces between the matches.

    The running position is carried over blocks of matches, so that a text
    with very many matches does not copy one ever longer array per match."""
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("m")))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _PREFIX_BLOCK).cast("int")),
        lambda b: F.slice(pairs, b * _PREFIX_BLOCK + 1, F.lit(_PREFIX_BLOCK)),
    )
    none = F.array().cast("array<struct<start:int,m:string>>")
    inside = F.transform(
        blocks,
        lambda block: F.aggregate(
            block,
            F.struct(F.lit(0).alias("pos"), none.alias("out")),
            lambda a, x: F.struct(
                (a["pos"] + x["gap"] + F.length(x["m"])).alias("pos"),
                F.concat(a["out"], F.array(F.struct((a["pos"] + x["gap"]).alias("start"), x["m"].alias("m")))).alias("out"),
            ),
        ),
    )
    joined = F.aggregate(
        inside,
        F.struct(F.lit(0).alias("pos"), F.array().cast("array<array<struct<start:int,m:string>>>").alias("out")),
        lambda a, block: F.struct(
            (a["pos"] + block["pos"]).alias("pos"),
            F.concat(a["out"], F.array(F.transform(block["out"], lambda e: F.struct((e["start"] + a["pos"]).alias("start"), e["m"].alias("m"))))).alias("out"),
        ),
    )
    return F.flatten(joined["out"])


def _confirmed(kind: str, t: Column, placed: Column) -> Column:
    """The matches that the kind's validator keeps, with their scores."""

    def scored(e: Column) -> Column:
        end = e["start"] + F.length(e["m"])
        before = F.substring(t, F.greatest(e["start"] - CONTEXT_REACH, F.lit(0)) + 1, F.least(e["start"], F.lit(CONTEXT_REACH)))
        after = F.substring(t, end + 1, F.lit(CONTEXT_REACH))
        near = F.lower(F.concat(before, F.lit(" "), after))
        hit = reduce(lambda a, b: a | b, [near.contains(w) for w in CONTEXT[kind]])
        score = F.lit(PRIOR[kind] + CONFIRMED[kind]) + F.when(hit, F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0))
        return F.struct(F.lit(kind).alias("kind"), e["start"].alias("start"), end.alias("end"), F.round(F.least(score, F.lit(1.0)), 2).alias("score"))

    spans = F.transform(F.filter(placed, lambda e: _valid(kind, e["m"])), scored)
    return spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= KEEP_FROM)


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with an array column ``out`` of its kept spans: kind, start,
    end (code points, end exclusive), score; by kind as listed, then start."""
    docs = without(docs, out, *[f"__{k}_{x}" for k in PATTERNS for x in "mg"])
    t = text_or_empty(text)
    span_type = "array<struct<kind:string,start:int,end:int,score:double>>"
    found = docs
    for kind, pattern in PATTERNS.items():
        found = found.withColumn(f"__{kind}_m", F.when(MAY_HOLD[kind](t), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))))
    for kind, pattern in PATTERNS.items():
        m = F.col(f"__{kind}_m")
        found = found.withColumn(f"__{kind}_g", F.when(F.size(m) > 0, F.split(t, pattern, -1)))
    spans = []
    for kind in PATTERNS:
        m, g = F.col(f"__{kind}_m"), F.col(f"__{kind}_g")
        kept = _confirmed(kind, t, _placed(g, m))
        spans.append(F.when(F.size(m) > 0, kept).otherwise(F.array().cast(span_type)))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], F.concat(*spans).alias(out))


def mask_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with ``[KIND]`` in place of every span of column ``out``; spans
    that overlap become one, named after the one that begins first."""
    t = text_or_empty(text)
    by_start = F.sort_array(F.transform(F.col(out), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("neg_end"), s["kind"].alias("kind"))))
    merged = F.aggregate(
        by_start,
        F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("parts")),
        lambda a, s: F.when(
            s["start"] >= a["pos"],
            F.struct(
                (-s["neg_end"]).alias("pos"),
                F.concat(a["parts"], F.array(F.substring(t, a["pos"] + 1, s["start"] - a["pos"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("parts"),
            ),
        ).otherwise(F.struct(F.greatest(a["pos"], -s["neg_end"]).alias("pos"), a["parts"].alias("parts"))),
    )
    clean = F.concat(F.array_join(merged["parts"], ""), F.substring(t, merged["pos"] + 1, F.length(t)))
    return docs.withColumn(text, F.when(F.size(out) > 0, clean).otherwise(F.col(text)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(_joined(F.filter("pii", lambda s: s["kind"].isin(*BASE))).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"),
    )
