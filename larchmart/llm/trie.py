"""Prefix trie of conversations with count-min screening (operator 13).

Every conversation is a path of turns, and every distinct path start is a node.  A
path start is known by a digest: the XOR of a 128-bit hash of every turn with its
place, so it is a running aggregate, and the digest of the parent is the digest
without the last turn.  Running aggregates (places of turns, digests, sums along a
path) are taken over range-partitioned slices of the order, with what earlier slices
hold of the same conversation added; a conversation of any length is spread over
slices, and no window holds more than a slice.

1. Screening.  All digests are counted in a count-min sketch of fixed depth (3 rows)
   and bounded width.  Only whether a counter is above one matters: what leaves the
   cluster is one bit per counter.  An estimate of one proves a digest unique; from the
   first unique node of a path on, all are.
2. Tails.  From there on the nodes of a path have one member, and are emitted where
   they are; nothing of them is grouped.
3. Grouping.  Only digests that may be shared are grouped (combined in the map tasks):
   members, smallest member, members that end here.  Sketch collisions only send
   unique nodes this way, too.
4. Subtrees need no walk: every node counts for its smallest member, and the nodes
   that count for one conversation are a run of its path.  Leaves and saved tokens are
   summed per conversation, joined to the member rows, and summed per node; what the
   smallest member's nodes above have is taken off by a running sum.
5. The identifiers that end at a node are sorted by slices, written as text in pieces
   of bounded length there, and run through SHA-256 piece by piece.

Defined results: null roles and texts are empty; rows without conv_id take no part;
turns of equal number go by role, then text (those that agree in 256 characters of both
by digest); repeated rows are repeated turns; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, cut, table

#: Counters per row of the sketch: a power of two, COUNTERS per digest, within these bounds.
COUNTERS = 4
LEAST_WIDTH, MOST_WIDTH = 1 << 16, 1 << 27
DEPTH = 3
#: Identifiers in a piece of text that is hashed.
PIECE = 512
#: Characters by which turns of equal number are put in order.
COMPARED = 256

#: Of the query (fixed values of the contract): a conversation takes over the first
#: turns, at most HEAD - 1, of the first one of its FAMILY.
HEAD = 6
FAMILY = 100

_BUCKET = 32768  # positions in one bitmap of bitmap_construct_agg
_OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def running(df: DataFrame, key: str, order: Sequence[Column], values: Mapping[str, tuple], keep: Sequence[str], label: str) -> DataFrame:
    """``keep`` and, for every ``out: (function, column)`` of ``values``, the
    aggregate of the key's rows up to and with this one in ``order`` (a total
    order).  The function must combine its own results (sum, bit_xor)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    inputs = {f"__in_{out}": column for out, (_, column) in values.items()}
    sliced = df.withColumns(inputs).repartitionByRange(n, F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    sliced = sliced.select(*dict.fromkeys([key, *keep]), *inputs, F.spark_partition_id().alias("__slice"), F.monotonically_increasing_id().alias("__at"))
    sliced = cut(sliced, label)
    here = Window.partitionBy("__slice", key).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.withColumns({out: function(f"__in_{out}").over(here) for out, (function, _) in values.items()})
    # a key that goes on in another slice is the last key of its own: at most one key a slice
    last = sliced.groupBy("__slice").agg(F.max(key).alias(key)).select(key).distinct()
    parts = sliced.join(F.broadcast(last), key).groupBy(key, "__slice").agg(*[function(f"__in_{out}").alias(out) for out, (function, _) in values.items()])
    before = Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(F.col(key).alias("__key"), F.col("__slice").alias("__of"), *[function(out).over(before).alias(f"__before_{out}") for out, (function, _) in values.items()])
    joined = local.join(F.broadcast(carried), (F.col(key) == F.col("__key")) & (F.col("__slice") == F.col("__of")), "left")
    whole = [F.coalesce(_both(function, F.col(out), F.col(f"__before_{out}")), F.col(out)).alias(out) for out, (function, _) in values.items()]
    return joined.select(*keep, *whole)


def _both(function, a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b) if function is F.bit_xor else a + b


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), t1, t2 (digest of role and text), chars of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    hashes = {f"t{i}": F.xxhash64(F.lit(i), "role", "text") for i in (1, 2)}
    rows = rows.withColumns(hashes | {"chars": F.char_length("text").cast("long"), "tie": F.monotonically_increasing_id()})
    # sort keys of bounded length: range boundaries are sampled to the driver
    starts = [F.left(c, F.lit(COMPARED)) for c in ("role", "text")]
    order = [F.col("turn").asc_nulls_first(), *starts, F.col("t1"), F.col("t2"), F.col("tie")]
    return running(rows, "conv_id", order, {"place": (F.sum, F.lit(1).cast("long"))}, ["conv_id", "t1", "t2", "chars"], "turns")


def rebuilt(turns: DataFrame, head: int = HEAD, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """(conv_id, total) of every conversation, and (conv_id, total, place, t1, t2,
    chars) of its turns, after it took over the first turns of its family's first."""
    own = cut(paths(turns), "places")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % head
    convs = own.groupBy("conv_id").agg(F.max("place").alias("own")).withColumn("h", taken.cast("int"))
    first = own.where((F.col("conv_id") % family == 0) & (F.col("place") < head)).groupBy(F.col("conv_id").alias("__first"))
    first = first.agg(F.sort_array(F.collect_list(F.struct("place", "t1", "t2", "chars"))).alias("head"))  # at most head - 1
    convs = convs.join(first, F.col("conv_id") - F.col("conv_id") % family == F.col("__first"), "left")
    none = F.expr("cast(array() as array<struct<place:bigint,t1:bigint,t2:bigint,chars:bigint>>)")
    convs = convs.withColumn("head", F.coalesce(F.slice("head", 1, F.col("h")), none))
    convs = convs.withColumn("total", F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = cut(convs.select("conv_id", "h", "head", "total"), "conversations")
    heads = convs.select("conv_id", "total", F.explode("head").alias("one")).select("conv_id", "total", "one.*")
    later = convs.select(F.col("conv_id").alias("__conv"), "h", "total", (F.size("head") - F.col("h")).alias("shift"))
    rest = own.join(later, (F.col("conv_id") == F.col("__conv")) & (F.col("place") > F.col("h")))
    rest = rest.select("conv_id", "total", (F.col("place") + F.col("shift")).alias("place"), "t1", "t2", "chars")
    return convs.select("conv_id", "total"), heads.unionByName(rest)


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, total, chars, the node's digest (d1, d2) and its parent's (p1, p2)."""
    hashed = turns.withColumns({"depth": F.col("place"), "h1": F.xxhash64("place", "t1", "t2"), "h2": F.xxhash64("place", "t2", "t1")})
    values = {"d1": (F.bit_xor, F.col("h1")), "d2": (F.bit_xor, F.col("h2"))}
    found = running(hashed, "conv_id", [F.col("depth")], values, ["conv_id", "depth", "total", "chars", "h1", "h2"], "prefixes")
    return found.select("conv_id", "depth", "total", "chars", "d1", "d2", F.col("d1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("d2").bitwiseXOR(F.col("h2")).alias("p2"))


def _counters(width: int) -> Column:
    """A digest's counter in every row of the sketch, rows one behind the other, from 1."""
    parts = (F.col("d1"), F.shiftrightunsigned("d1", 32), F.col("d2"))
    return F.array(*[part.bitwiseAND(F.lit(width - 1)) + (1 + row * width) for row, part in enumerate(parts[:DEPTH])])


def screened(found: DataFrame, width: int | None = None) -> DataFrame:
    """``found`` and whether the sketch proves a row's digest unique (``alone``)."""
    spark = found.sparkSession
    width = width or max(LEAST_WIDTH, min(MOST_WIDTH, 1 << (COUNTERS * found.count()).bit_length()))
    counts = found.select(F.explode(_counters(width)).alias("at")).groupBy("at").count()
    several = counts.where("count > 1").groupBy(F.bitmap_bucket_number("at").alias("bucket"))
    bits = bytearray(-(-DEPTH * width // _BUCKET) * _BUCKET // 8)
    # at most a bit per counter comes to the driver
    for row in several.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect():
        start = (row["bucket"] - 1) * _BUCKET // 8
        bits[start : start + len(row["bits"])] = row["bits"]
    shared = spark.sparkContext.broadcast(bytes(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, mask = np.frombuffer(shared.value, np.uint8), np.uint64(width - 1)
        for batch in batches:
            d1, d2 = (batch.column(batch.schema.get_field_index(c)).to_numpy().view(np.uint64) for c in ("d1", "d2"))
            alone = np.zeros(len(d1), bool)
            for row, part in enumerate((d1, d1 >> np.uint64(32), d2)):
                at = (part & mask) + np.uint64(row * width)
                alone |= ((sketch[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1) == 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(alone)], [*batch.schema.names, "alone"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields)
    return arrow_map(found, run, f"{kinds}, alone boolean")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Identifiers in order -> text of at most PIECE of one node each."""
    for batch in batches:
        d1, d2, ids = (batch.column(i) for i in range(3))
        a, b = d1.to_numpy(), d2.to_numpy()
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
        starts = np.concatenate([np.arange(s, e, PIECE) for s, e in zip(new, [*new[1:], len(a)], strict=True)] or [new]).astype(np.int64)
        texts = pa.ListArray.from_arrays(pa.array([*starts, len(a)], pa.int32()), ids.cast(pa.string()))
        take = pa.array(starts)
        yield pa.RecordBatch.from_arrays([d1.take(take), d2.take(take), ids.take(take), pa.compute.binary_join(texts, ",")], ["d1", "d2", "first", "text"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces by node and first identifier -> one SHA-256 a node."""
    at, digest = None, None
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.string())], ["d1", "d2", "sha"])

    for batch in batches:
        for d1, d2, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if (d1, d2) == at:
                digest.update(b",")
            else:
                if at is not None:
                    done.append((*at, digest.hexdigest()))
                at, digest = (d1, d2), hashlib.sha256()
            digest.update(text.encode())
        if done:
            yield out()
            done = []
    if at is not None:
        done = [(*at, digest.hexdigest())]
        yield out()


def _end_hashes(ends: DataFrame) -> DataFrame:
    """d1, d2, sha: hash of the identifiers in order, comma-joined, of every node."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ("d1", "d2", "conv_id")
    pieces = arrow_map(ends.select(*by).repartitionByRange(n, *by).sortWithinPartitions(*by), _pieces, "d1 long, d2 long, first long, text string")
    return arrow_map(pieces.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "first"), _hashed, "d1 long, d2 long, sha string")


def prefix_trie(convs: DataFrame, turns: DataFrame, width: int | None = None) -> DataFrame:
    """One row per node of the trie of conversations ``convs`` (conv_id, total) with
    turns ``turns`` (see ``rebuilt`` for the columns and the module for the method)."""
    flagged = cut(screened(cut(prefixes(turns), "digests"), width), "screened")
    start = flagged.where("alone").groupBy(F.col("conv_id").alias("__conv")).agg(F.min("depth").alias("tail"))
    split = cut(flagged.drop("alone").join(start, F.col("conv_id") == F.col("__conv"), "left").drop("__conv"), "split")
    tails = split.where("depth >= tail")
    shared = split.where("tail IS NULL OR depth < tail")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())

    nodes = shared.groupBy("d1", "d2").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("chars").alias("chars"),
        F.count_if(F.col("depth") == F.col("total")).alias("n_ends"),
    )
    nodes = cut(nodes.withColumn("saving", (F.col("n_convs") - 1) * F.col("chars")), "nodes")
    top = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    smallest = convs.agg(F.min("conv_id")).scalar()

    # what counts for a conversation: its leaf, and the savings of the nodes of which it is the smallest member
    starts = tails.where("depth = tail")
    leaves = starts.select("conv_id", one.alias("leaf"), zero.alias("saving"))
    leaves = leaves.unionByName(nodes.select("conv_id", (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"), "saving"))
    counting = leaves.groupBy("conv_id").agg(F.sum("leaf").alias("leaf"), F.sum("saving").alias("saving"))
    counting = cut(counting.where("leaf > 0 OR saving > 0").withColumnRenamed("conv_id", "__conv"), "counting")
    below = shared.select("d1", "d2", "conv_id").join(counting, F.col("conv_id") == F.col("__conv")).groupBy("d1", "d2")
    below = below.agg(F.sum("leaf").alias("leaf"), F.sum("saving").alias("in_subtree"))
    above = running(nodes, "conv_id", [F.col("depth")], {"upto": (F.sum, F.col("saving"))}, ["d1", "d2", "saving", "n_convs", "depth", "conv_id", "p1", "p2"], "savings")
    children = nodes.select("p1", "p2").unionByName(starts.select("p1", "p2")).groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n_children"))
    children = cut(children, "children")
    no_turns = convs.where("total = 0").select(zero.alias("d1"), zero.alias("d2"), "conv_id")
    hashes = cut(_end_hashes(shared.where("depth = total").select("d1", "d2", "conv_id").unionByName(no_turns)), "ends")

    def on(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
        """Left join of ``left`` with ``right`` on a digest; its columns keep their left names."""
        r = right.withColumnsRenamed({f"{b}1": "__k1", f"{b}2": "__k2"})
        return left.join(r, (F.col(f"{a}1") == F.col("__k1")) & (F.col(f"{a}2") == F.col("__k2")), "left").drop("__k1", "__k2")

    parents = nodes.select("d1", "d2", F.col("conv_id").alias("parent"))
    parent = F.when(F.col("depth") == 1, smallest).otherwise(F.col("parent")).alias("parent_conv_id")
    grouped = on(on(on(on(above, parents, "p", "d"), below, "d", "d"), children, "d", "p"), hashes, "d", "d").select(
        "conv_id", "depth", parent, "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), F.coalesce("leaf", zero).alias("n_leaves"),
        (F.coalesce("in_subtree", zero) - (F.col("upto") - F.col("saving"))).alias("saved_tokens"), F.coalesce("sha", nothing).alias("ends_sha256"),
    )

    alone = lambda parent: (
        "conv_id", "depth", parent.alias("parent_conv_id"), one.alias("n_convs"),
        (F.col("depth") < F.col("total")).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("depth") == F.col("total"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"),
    )
    first = on(starts, parents, "p", "d").select(*alone(F.when(F.col("depth") == 1, smallest).otherwise(F.col("parent"))))
    later = tails.where("depth > tail").select(*alone(F.col("conv_id")))

    total = {c: counting.agg(F.sum(c)).scalar() for c in ("leaf", "saving")}
    root = on(on(top.withColumns(total | {"d1": zero, "d2": zero}), children, "d", "p"), hashes, "d", "d").select(
        "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), F.greatest(F.coalesce("leaf", one), one).alias("n_leaves"),
        F.coalesce("saving", zero).alias("saved_tokens"), F.coalesce("sha", nothing).alias("ends_sha256"),
    )
    return root.select(*_OUT).unionByName(grouped.select(*_OUT)).unionByName(first.select(*_OUT)).unionByName(later.select(*_OUT))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of the rebuilt ``conversations``."""
    return prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))


ORACLE_SQL = """
WITH c AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns,
         CAST(conv_id AS VARCHAR) AS name
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(name[i]) AS BIGINT))),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 6 AS h
  FROM c
), s AS (
  SELECT h.conv_id, list_concat(coalesce(f.turns[1:h.h], []), h.turns[h.h + 1:]) AS seq
  FROM h LEFT JOIN c f ON f.conv_id = h.conv_id - h.conv_id % 100
), p AS (
  SELECT conv_id, len(seq) AS total, d AS depth, seq[1:d] AS path FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM s)
), n AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE total = depth), '')) AS ends_sha256
  FROM p GROUP BY depth, path
), k AS (
  SELECT v.depth, v.path, any_value(v.conv_id) AS conv_id, any_value(v.n_convs) AS n_convs, any_value(v.ends_sha256) AS ends_sha256,
         any_value(u.conv_id) AS parent_conv_id, (SELECT count(*) FROM n w WHERE w.depth = v.depth + 1 AND w.path[1:v.depth] = v.path) AS n_children
  FROM n v LEFT JOIN n u ON u.depth = v.depth - 1 AND u.path = v.path[1:v.depth - 1]
  GROUP BY v.depth, v.path
)
SELECT v.conv_id, v.depth, any_value(v.parent_conv_id) AS parent_conv_id, any_value(v.n_convs) AS n_convs,
       any_value(v.n_children) AS n_children, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves,
       CAST(sum(CASE WHEN u.depth = 0 THEN 0 ELSE (u.n_convs - 1) * length(u.path[-1].t) END) AS BIGINT) AS saved_tokens,
       any_value(v.ends_sha256) AS ends_sha256
FROM k v JOIN k u ON u.depth >= v.depth AND u.path[1:v.depth] = v.path
GROUP BY v.conv_id, v.depth
"""
