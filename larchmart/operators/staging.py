"""Staging: raw JSON documents -> typed rows (one per document).

Each document is parsed exactly once with ``from_json`` into an all-STRING
struct and then cast, mirroring "extract text, then cast": a numeric JSON
value, a quoted number and a boolean all reach the cast as text.  The cast
runs under the session's ANSI setting, so malformed values raise like the
original databases do.  ``stage_entity``, which the build uses, sets such
documents apart in a rejects table instead, and counts them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import bool_flag
from ..sources.schemas import STAGING_FIELDS, payload_struct

# Text forms of a true conversion flag.
TRUE_TEXTS = ("true", "1")
CORRUPT = "_corrupt"


def json_extract(payload: Column | str, key: str) -> Column:
    """Single top-level key as text (the per-key extractor).

    Prefer ``parse_entity`` for whole documents: it parses once per row,
    whereas one ``json_extract`` per key re-parses the payload each time.
    """
    p = F.col(payload) if isinstance(payload, str) else payload
    return F.get_json_object(p, f"$.{key}")


def _typed(text: Column, name: str, typ: str, safe: bool) -> Column:
    if name == "is_converted":
        return bool_flag(F.lower(text).isin(*TRUE_TEXTS))
    return text.try_cast(typ) if safe else text.cast(typ)


def parse_entity(raw: DataFrame, entity: str, safe: bool = False) -> DataFrame:
    """Raw ``(id, payload, _ingested_at)`` -> the entity's staging columns."""
    doc = raw.select(F.from_json("payload", payload_struct(entity)).alias("doc"), "_ingested_at")
    cols = [_typed(F.col(f"doc.{key}"), name, typ, safe).alias(name) for name, typ, key in STAGING_FIELDS[entity]]
    return doc.select(*cols, "_ingested_at")


def checked_documents(raw: DataFrame, entity: str) -> DataFrame:
    """Every document once: ``id, payload``, the entity's staging columns (what does
    not cast is NULL), ``_ingested_at``, ``is_object`` (whether the payload is a JSON
    object) and ``bad_keys`` (the keys whose non-null text failed its cast)."""
    # one parse: it keeps the text of what is not JSON; an array of objects would pass as its first
    schema = payload_struct(entity).add(CORRUPT, "string")
    doc = F.from_json("payload", schema, {"columnNameOfCorruptRecord": CORRUPT})
    # generated, not projected: a filter on the document is put below a projection, where
    # it would parse once for every key it looks at
    doc = F.explode(F.array(doc)).alias("doc")
    braced = F.coalesce(F.startswith(F.btrim("payload", F.lit(" \t\r\n")), F.lit("{")), F.lit(False))
    parsed = raw.select("id", "payload", "_ingested_at", doc, braced.alias("braced"))
    is_object = F.col("braced") & F.col(f"doc.{CORRUPT}").isNull()
    fields = STAGING_FIELDS[entity]
    typed = [_typed(F.col(f"doc.{key}"), name, typ, True).alias(name) for name, typ, key in fields]
    checks = [
        F.when(F.col(f"doc.{key}").isNotNull() & F.col(f"doc.{key}").try_cast(typ).isNull(), F.lit(key))
        for name, typ, key in fields
        if name != "is_converted"
    ]
    return parsed.select("id", "payload", *typed, "_ingested_at", is_object.alias("is_object"), F.array_compact(F.array(*checks)).alias("bad_keys"))


def is_reject() -> Column:
    """Of ``checked_documents``: not an object, or with a value that does not cast."""
    return ~F.col("is_object") | (F.size("bad_keys") > 0)


def rejects(raw: DataFrame, entity: str) -> DataFrame:
    """Documents that are not JSON objects or carry a value that does not cast.

    Returns ``(id, payload, _ingested_at, bad_keys)``; ``bad_keys`` lists the
    keys whose non-null text failed its cast (empty for unparseable text).
    """
    return checked_documents(raw, entity).where(is_reject()).select("id", "payload", "_ingested_at", "bad_keys")


@dataclass(frozen=True)
class Staged:
    """What ``stage_entity`` wrote."""

    accepted: DataFrame
    documents: int
    rejected: int
    rejects: DataFrame | None


def stage_entity(raw: DataFrame, entity: str, table_path: str, rejects_path: str) -> Staged:
    """Write the staging table of ``entity``, and apart from it the documents that
    do not parse (``rejects``), so that one bad document stops nothing and none is
    lost.  Both counts are observed while the table is written; only where there
    are rejects are the documents read again."""
    spark = raw.sparkSession
    seen = Observation(f"staged_{entity}")
    every = checked_documents(raw, entity)
    counted = every.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(is_reject()).alias("bad"))
    columns = [name for name, _, _ in STAGING_FIELDS[entity]]
    counted.where(~is_reject()).select(*columns, "_ingested_at").write.mode("overwrite").parquet(table_path)
    n, bad = int(seen.get["n"]), int(seen.get["bad"])
    apart = None
    if bad:
        every.where(is_reject()).select("id", "payload", "_ingested_at", "bad_keys").write.mode("overwrite").parquet(rejects_path)
        apart = spark.read.parquet(rejects_path)
    return Staged(spark.read.parquet(table_path), n, bad, apart)
