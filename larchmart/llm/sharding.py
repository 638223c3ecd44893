"""Sharding by fixed virtual slots (operator 3, DataFrame functions only).

Rows hash into a fixed number of virtual slots (thousands, a parameter that
does not grow with the data); bytes are summed per slot; a versioned table
maps every slot to a shard and is edited, not rebuilt, when the shards are out
of balance.  Law of the result: ``bytes`` - the shards' sizes are near equal.

A row hashes by id and text, so that rows under one id are spread.  Where a
slot is still heavier than a ``HEAVY``-th of a shard (a row that repeats very
often, or a very long one), its rows are dealt over all slots one by one.

Defined results: a null text has no bytes (size 1); a null id hashes like any
other; repeated rows are rows of their own; an empty table gives an empty
result (the map's next version then equals its newest); other columns are
ignored.  A folder that holds a map is read at its newest version, edited, and
given the next one; shards beyond the number asked for are emptied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.files import listing
from .common import cut, shared_path, table, text_or_empty

SHARDS = 16
SLOTS = 4096
#: A slot heavier than this part of a shard's mean load is taken apart.
HEAVY = 16


def slot_of(doc_id: Column, text: Column, slots: int) -> Column:
    """Virtual slot of a row: a hash of its id and text."""
    return F.pmod(F.xxhash64(doc_id, text), F.lit(slots))


def sized_rows(docs: DataFrame, slots: int) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, virtual_slot and a number of every row."""
    text = text_or_empty()
    return docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        slot_of(F.col("doc_id"), text, slots).cast("long").alias("virtual_slot"),
        F.monotonically_increasing_id().alias("nth"),
    )


def without_heavy_slots(rows: DataFrame, slots: int, shards: int) -> DataFrame:
    """``rows`` (written: their numbers must not change) with the rows of heavy
    slots dealt over all slots; fewer than HEAVY * shards slots can be heavy."""
    per = slot_bytes(rows)
    total = per.agg(F.sum("bytes")).scalar()
    heavy = per.where(F.col("bytes") * F.lit(HEAVY * shards) > total).select(F.col("virtual_slot").alias("__slot"))
    dealt = F.pmod(F.xxhash64("doc_id", "text_crc32", "nth"), F.lit(slots)).cast("long")
    marked = rows.join(F.broadcast(heavy), F.col("virtual_slot") == F.col("__slot"), "left")
    return marked.withColumn("virtual_slot", F.when(F.col("__slot").isNull(), F.col("virtual_slot")).otherwise(dealt)).drop("__slot", "nth")


def first_map(spark: SparkSession, slots: int, shards: int) -> DataFrame:
    """Version 0: the slots dealt to the shards in turn."""
    return spark.range(slots).select(
        F.lit(0).alias("version"), F.col("id").alias("virtual_slot"), F.pmod("id", F.lit(shards)).cast("int").alias("shard")
    )


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Bytes and rows per virtual slot (summed map-side before the shuffle)."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def rebalance(slot_map: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version of ``slot_map``: each shard keeps its largest slots up
    to the mean load; the slots beyond that (its smallest) are lifted and go,
    largest first, each to the shard with the least load.

    ``slot_map`` and ``weights`` have a row per virtual slot at most, so the
    windows and the one-row fold below are bounded by the number of slots.
    """
    w = slot_map.join(weights, "virtual_slot", "left").select(
        "version", "virtual_slot", "shard", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes")
    )
    held = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    w = w.withColumn("upto", F.sum("bytes").over(held)).withColumn(
        "stays",
        (F.col("shard") < shards) & ((F.col("upto") <= F.sum("bytes").over(Window.partitionBy()) / F.lit(shards)) | (F.col("bytes") == 0)),
    )
    entry = F.struct((-F.col("bytes")).alias("neg"), F.col("virtual_slot"))
    state = w.agg(
        F.sort_array(F.collect_list(F.when(~F.col("stays"), entry))).alias("lifted"),
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("kept"),
        F.max("version").alias("version"),
    )

    def kept_load(shard: Column) -> Column:
        own = F.filter("kept", lambda x: x["shard"] == shard)
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x["bytes"])

    zero = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), kept_load)
    start = F.struct(zero.alias("load"), F.array().cast("array<struct<virtual_slot:bigint,shard:int>>").alias("moved"))

    def place(acc: Column, slot: Column) -> Column:
        least = (F.array_position(acc["load"], F.array_min(acc["load"])) - F.lit(1)).cast("int")
        return F.struct(
            F.transform(acc["load"], lambda v, i: F.when(i == least, v - slot["neg"]).otherwise(v)).alias("load"),
            F.concat(acc["moved"], F.array(F.struct(slot["virtual_slot"].alias("virtual_slot"), least.alias("shard")))).alias("moved"),
        )

    moved = state.select(F.explode(F.aggregate("lifted", start, place)["moved"]).alias("m")).select("m.virtual_slot", F.col("m.shard").alias("to"))
    return w.join(moved, "virtual_slot", "left").select(
        (F.col("version") + F.lit(1)).alias("version"), "virtual_slot", F.coalesce("to", "shard").alias("shard")
    )


def store_map(slot_map: DataFrame, folder: str) -> None:
    """Add a version to the map's folder; earlier versions stay readable."""
    slot_map.write.mode("append").partitionBy("version").parquet(folder)


def newest_version(spark: SparkSession, folder: str) -> int | None:
    """The newest version in the map's folder; None where it holds no map."""
    if not any(path.endswith(".parquet") for path, _, _ in listing(spark, folder)):
        return None
    return spark.read.parquet(folder).agg(F.max("version")).first()[0]


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.parquet(folder).where(F.col("version") == version)


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (the row's place in its shard, from
    0 without gaps), virtual_slot, map_version of every row of ``docs``.

    The newest map of ``map_folder`` (default: a new folder in the shared folder;
    version 0, as dealt, where it holds none) is edited on the slots' bytes, and
    stored as the next version.
    """
    spark = docs.sparkSession
    folder = map_folder or shared_path(spark, "slot-map")
    rows = without_heavy_slots(cut(sized_rows(docs, slots), "sized"), slots, shards)
    weights = slot_bytes(rows)
    version = newest_version(spark, folder)
    if version is None:
        version = 0
        store_map(first_map(spark, slots, shards), folder)
    newest = read_map(spark, folder, version)
    if newest.count() != slots:
        raise ValueError(f"the map in {folder} has {newest.count()} slots, not {slots}")
    store_map(rebalance(newest, weights, shards), folder)
    edited = read_map(spark, folder, version + 1)
    # a row per virtual slot: the prefix windows are bounded by the slots
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = edited.join(weights, "virtual_slot", "left").select(
        "virtual_slot", "shard", F.col("version").cast("int").alias("map_version"),
        F.coalesce(F.sum(F.coalesce("n_rows", F.lit(0))).over(before), F.lit(0)).alias("base"),
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("at", F.row_number().over(inside) - F.lit(1))
        .join(F.broadcast(placed), "virtual_slot")  # one row per virtual slot: a fixed number
        .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("at")).cast("long").alias("slot"), "virtual_slot", "map_version")
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
