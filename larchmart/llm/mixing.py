"""Mixing sources to target weights (operator 1).

Pivotal dependent rounding.  A document of a source is wanted ``p`` times,
``p`` being the source's target over its size: ``floor(p)`` copies are sure
and the fraction is its copy probability.  Two fractional documents of a
source are paired and words of probability mass move from one to the other, in
a random direction whose odds keep both expectations, until one of the two is
integral; the other stays in play.  Mass is counted in words, so a pairing
never changes the source's expected words.  Only the last residual of a source
is rounded outright, and that error is settled on the last group's documents.  Groups of a bounded number of documents are reduced
to one residual each, the residuals are grouped and reduced again: a tree
whose groups never depend on how large a source is.

Rows equal in id, source and text are one unit: as many of them as their common
expectation says take one copy more, and what is left of it is the fraction of
one row, so no unit's mass exceeds one document's, however often it repeats.

Defined results: a null text has size 0 and takes nothing; a null source is a
source of its own, last in order; which of the rows of a unit take one copy more
is open (they are equal but for extra columns); a source whose documents are all empty has target 0; an empty table
gives an empty result; other columns are kept by ``mix_sources`` and ignored
by ``mix_plan``.
"""

from __future__ import annotations

import hashlib
import random

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, ship, table, text_or_empty, without
from ..operators.ranking import global_rank

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
#: Documents that one pairing group reduces to one residual.
FAN_IN = 1024
SEED = 20260

#: Rows of a unit that one task writes out at most.
ROWS = 1 << 16

_EPS = 1e-9


def units(docs: DataFrame) -> DataFrame:
    """Rows equal in id, source and text, with their number."""
    sized = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text_or_empty()).alias("text_hash")
    )
    return sized.groupBy("doc_id", "source", "size", "text_hash").agg(F.count(F.lit(1)).alias("rows"))


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, n, source_size, target: the weights go round the sources by code
    point, null last, and share all words; a target stops at ``cap`` times its
    source's size and the excess is reshared by weight until none is above."""
    per = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("n"))
    ranked = global_rank(cut(per, "sources"), [F.col("source").asc_nulls_last()], rank_col="__rank", total_col="__total")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("__rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    src = cut(ranked.select("source", "n", "source_size", weight.alias("weight")), "weights")
    total = src.agg(F.sum("source_size")).first()[0] or 0
    top = F.col("source_size") * F.lit(float(cap))
    level = None  # words per unit of weight; a source is capped once level * weight passes its cap
    while True:
        capped = F.lit(False) if level is None else F.lit(level) * F.col("weight") > top
        row = src.agg(F.sum(F.when(capped, top)).alias("fixed"), F.sum(F.when(~capped, F.col("weight"))).alias("open"), F.sum(F.when(capped, 1).otherwise(0)).alias("k")).first()
        if not row["open"]:
            break
        nxt = (total - (row["fixed"] or 0.0)) / row["open"]
        if level is not None and nxt <= level * (1 + 1e-12):
            break
        level = nxt
    target = F.least(top, F.lit(level or 0.0) * F.col("weight")) if level is not None else top
    return src.select("source", "n", F.col("source_size").cast("long").alias("source_size"), target.cast("double").alias("target"))


def _pair(rows: list[dict], rng: random.Random) -> list[dict]:
    """Reduce the fractions ``p`` of ``rows`` until one at most is fractional."""
    live = None
    for r in rows:
        if not _EPS < r["p"] < 1 - _EPS:
            r["p"] = float(round(r["p"]))
            continue
        if live is None:
            live = r
            continue
        a, b = live, r  # words that can move from b to a, and from a to b
        to_a = min((1 - a["p"]) * a["mass"], b["p"] * b["mass"])
        to_b = min((1 - b["p"]) * b["mass"], a["p"] * a["mass"])
        move = to_a if rng.random() * (to_a + to_b) < to_b else -to_b
        a["p"] += move / a["mass"]
        b["p"] -= move / b["mass"]
        for x in (a, b):
            if not _EPS < x["p"] < 1 - _EPS:
                x["p"] = float(round(x["p"]))
        open_ = [x for x in (a, b) if 0 < x["p"] < 1]
        live = open_[-1] if open_ else None
        if len(open_) == 2:
            raise AssertionError("a pairing left two fractions")
    return rows


def _settle(rows: list[dict], wanted: float, rng: random.Random) -> None:
    """Round the source's last residual, and undo its rounding error (up to one
    long document) by turning over decided documents, longest first, while that
    brings the words taken nearer to ``wanted``."""
    for r in rows:
        if 0 < r["p"] < 1:
            r["p"] = float(rng.random() < r["p"])
    error = sum(r["p"] * r["mass"] for r in rows) - wanted
    for r in rows:
        turn = r["mass"] if r["p"] == 0 else -r["mass"]
        if abs(error + turn) < abs(error):
            r["p"], error = 1 - r["p"], error + turn


def _reducer(final: bool):
    def reduce_group(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["mass", "doc_key"], ascending=[False, True], kind="stable")
        rows = group.to_dict("records")
        seed = hashlib.sha256(f"{SEED}:{group['level'].iloc[0]}:{group['doc_key'].min()}:{len(group)}".encode()).digest()
        rng = random.Random(seed)
        wanted = sum(r["p"] * r["mass"] for r in rows)
        _pair(rows, rng)
        if final:
            _settle(rows, wanted, rng)
        for r in rows:
            r["done"] = not 0 < r["p"] < 1
        return pd.DataFrame(rows, columns=list(group.columns) + ["done"])

    return reduce_group


def decide(docs: DataFrame, weights: tuple[float, ...], cap: float, fan_in: int) -> DataFrame:
    """doc_id, source, size, text_hash, rows, source_size, target, sure, more: one
    row per unit, whose ``rows`` rows are each taken ``sure`` times and ``more`` of
    them once more."""
    ship(docs.sparkSession)
    u = cut(units(docs), "units")
    targets = cut(source_targets(u, weights, cap), "targets")
    t = targets.select(F.col("source").alias("__source"), "n", "source_size", "target")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    key = F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string"), F.col("text_hash").cast("string")), 256)
    per_row = F.when(F.col("size") > 0, F.greatest(wanted - F.col("sure"), F.lit(0.0))).otherwise(F.lit(0.0))
    start = (
        u.join(t, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("sure", F.floor(wanted + F.lit(_EPS)).cast("long"))
        .withColumn("p", per_row * F.col("rows"))
        .withColumn("more", F.floor(F.col("p") + F.lit(_EPS)).cast("long"))
        .withColumn("p", F.greatest(F.col("p") - F.col("more"), F.lit(0.0)))
        .withColumn("mass", F.col("size").cast("double"))
        .withColumn("doc_key", key)
        .withColumn("done", F.col("p") <= _EPS)
        .drop("__source")
    )
    state = cut(start, "fractions")
    decided = [state.where("done").withColumn("p", F.lit(0.0))]
    live, level = state.where("NOT done"), 0
    # residuals per source shrink by fan_in with every level; the depth follows the largest source
    widest = live.groupBy("source").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    while widest:
        final = widest <= fan_in
        groups = F.lit(0).cast("long") if final else F.pmod(F.xxhash64("doc_key", F.lit(level)), F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(fan_in * 1.0))).cast("long"))
        grouped = live.withColumn("level", F.lit(level)).withColumn("grp", groups).drop("done")
        schema = grouped.withColumn("done", F.lit(True)).schema
        out = cut(grouped.groupBy("source", "grp").applyInPandas(_reducer(final), schema).drop("level", "grp"), f"level{level}")
        decided.append(out.where("done").select(*state.columns))
        live = out.where("NOT done").select(*state.columns).withColumn("n", F.ceil(F.col("n") / F.lit(fan_in * 1.0)).cast("long"))
        widest = 0 if final else live.groupBy("source").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        level += 1
    every = decided[0]
    for d in decided[1:]:
        every = every.unionByName(d)
    return every.select("doc_id", "source", "size", "text_hash", "rows", "source_size", "target", "sure", (F.col("more") + F.col("p").cast("long")).alias("more"))


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, source, size, rows, source_size, target, copies: ``rows`` equal rows
    that are each taken ``copies`` times; a unit whose rows differ in that is two rows."""
    kinds = F.array(
        F.struct(F.col("more").alias("rows"), (F.col("sure") + 1).alias("copies")),
        F.struct((F.col("rows") - F.col("more")).alias("rows"), F.col("sure").alias("copies")),
    )
    plan = decide(docs, weights, cap, fan_in).select("doc_id", "source", "size", "source_size", "target", F.explode(kinds).alias("k"))
    return plan.where("k.rows > 0").select("doc_id", "source", "size", F.col("k.rows").alias("rows"), "source_size", "target", F.col("k.copies").alias("copies"))


def each_row(plan: DataFrame) -> DataFrame:
    """``plan`` (of ``mix_plan``) with a row for each of its ``rows``; those that
    repeat very often are dealt over the tasks in stretches of ``ROWS``."""
    few = plan.where(F.col("rows") <= ROWS)
    many = plan.where(F.col("rows") > ROWS).withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(ROWS).cast("long"))))
    many = many.withColumn("rows", F.least(F.lit(ROWS).cast("long"), F.col("rows") - F.col("__from"))).repartition("doc_id", "__from").drop("__from")
    return few.unionByName(many).withColumn("__row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).drop("__row")


def _first_rows(rows: DataFrame) -> DataFrame:
    """``rows`` of units of which only ``__more`` rows take one copy more, with
    ``__copies``; rows are counted in the parts they were read in, so that a unit
    never arrives in one task."""
    unit = ["__id", "__source", "__n", "__hash"]
    before = Window.partitionBy(*unit).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy(*unit, "__part").agg(F.count(F.lit(1)).alias("__in"))
    per = per.withColumn("__before", F.coalesce(F.sum("__in").over(before), F.lit(0))).select(*[F.col(c).alias(f"{c}_p") for c in [*unit, "__part"]], "__before")
    same = F.lit(True)
    for c in [*unit, "__part"]:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_p"))
    numbered = rows.withColumn("__nth", F.row_number().over(Window.partitionBy(*unit, "__part").orderBy("__part")))
    first = F.col("__nth") + F.col("__before") <= F.col("__more")
    return numbered.join(per, same).withColumn("__copies", F.col("__sure") + F.when(first, 1).otherwise(0))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, fan_in: int = FAN_IN) -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as the mix takes it."""
    docs = without(docs, "__text", "__size", "__copies", "__copy", "__id", "__source", "__n", "__hash", "__sure", "__more", "__rows", "__part", "__nth")
    plan = decide(docs, weights, cap, fan_in).where("sure > 0 OR more > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__n"), F.col("text_hash").alias("__hash"),
        F.col("rows").alias("__rows"), F.col("sure").alias("__sure"), F.col("more").alias("__more"),
    )
    plan = cut(plan, "copies")
    uneven = F.col("__more").between(1, F.col("__rows") - 1)
    parted = cut(plan.where(uneven).drop("__rows"), "parted")  # units with rows of both kinds: only repeated rows
    alike = plan.where(~uneven).withColumn("__copies", F.col("__sure") + F.when(F.col("__more") > 0, 1).otherwise(0))
    src = docs.withColumn("__text", F.xxhash64(text_or_empty()))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").cast("string").eqNullSafe(F.col("__source")) & (F.col("__text") == F.col("__hash"))
    # the plan follows the corpus: whole texts move once, at every size
    taken = src.join(alike.hint("merge"), same).select(*[F.col(f"`{c}`") for c in docs.columns], "__copies")
    rows = cut(src.withColumn("__part", F.spark_partition_id()).join(parted, same), "repeated")
    taken = taken.unionByName(_first_rows(rows).select(*taken.columns)).where("__copies > 0")
    copies = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = each_row(mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
