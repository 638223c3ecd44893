"""Exact top-k inner-product search (operator 11).

Queries and candidates are dealt into groups of bounded size: about
``TILE_QUERIES`` queries and about ``TILE_ROWS`` candidates.  Every pair of a query
group and a candidate group is a tile.  A task multiplies the two matrices of its
tile in slices, keeps the ``k`` best of every query by a partial selection, and
sends one list of at most ``k`` entries per query on.  The lists of a query are
merged in a tree: ``FAN_IN`` lists to one per level, until one is left.  So no task
holds more than a tile or ``FAN_IN`` lists, whatever the table's size, and a
vector that many rows share is spread over the groups like any other (rows are
dealt by their place in the file, not by value).

Scores are exact.  A tile whose products stay below 2**53 is multiplied in
double precision (every step is an exact integer there), one whose products fit
64 bits in 64-bit integers, any other in Python's.  A score beyond 64 bits is held
at the nearest 64-bit number.

Defined results: a vector that is null or holds a null or non-finite component
takes no part, nor does a row without an id; vectors of different lengths are not
compared, and a vector without components scores 0 with the others; equal scores
go to the smaller id; repeated rows are candidates each, and one query; a row is no
candidate for the queries of its own id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, ship, table

#: Queries and candidates of a tile, queries multiplied at once, lists merged at once.
TILE_QUERIES = 2048
TILE_ROWS = 8192
SLICE = 256
FAN_IN = 16

#: Of the query: a component x counts as floor(SCALE * x); every STEP-th id is a query.
SCALE = 64.0
STEP = 20
TOP = 20

_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1
_LISTS = "query_id long, shard long, best array<struct<neg:decimal(20,0),vec_id:long>>"


def _matrix(t: pa.Table, scale: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids ascending, and the vectors as rows of whole numbers."""
    ids = t.column("id").to_numpy()
    flat = t.column("vector").combine_chunks().flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    m = flat.reshape(len(ids), -1) if len(ids) else np.zeros((0, 0))
    order = np.argsort(ids, kind="stable")
    m = m[order]
    return ids[order], np.floor(m * scale) if scale else m


def best_of_tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, np.ndarray, list[int]]]:
    """(query id, candidate ids, scores) for every query of a tile: its k best,
    by score descending, then id.  ``c_ids`` ascend."""
    out = []
    bound = (np.abs(q).max(initial=0) + 1.0) * (np.abs(c).max(initial=0) + 1.0) * max(q.shape[1], 1)
    n = len(c_ids)
    place = np.arange(n, dtype=np.float64)
    for at in range(0, len(q_ids), SLICE):
        ids = q_ids[at : at + SLICE]
        if bound * n < _EXACT:
            # one number per pair that orders by score, then by place: no ties
            keys = (q[at : at + SLICE] @ c.T) * n - place
            own = ids[:, None] == c_ids[None, :] if np.isin(ids, c_ids).any() else None
            if own is not None:
                keys[own] = -np.inf
            few = min(k, n)
            top = np.argpartition(-keys, few - 1, axis=1)[:, :few]
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(keys, top, 1), axis=1), 1)
            for i, j in enumerate(top):
                j = j[np.isfinite(keys[i, j])]
                out.append((int(ids[i]), c_ids[j], [int(x) for x in (keys[i, j] + place[j]) / n]))
        elif bound < _LONG // 2:
            scores = q[at : at + SLICE].astype(np.int64) @ c.astype(np.int64).T
            for vec_id, row in zip(ids, scores, strict=True):
                order = np.argsort(-row, kind="stable")
                order = order[c_ids[order] != vec_id][:k]
                out.append((int(vec_id), c_ids[order], row[order].tolist()))
        else:
            columns = [[int(x) for x in row] for row in c]
            for i, vec_id in enumerate(ids):
                row = [int(x) for x in q[at + i]]
                scores = [max(-_LONG - 1, min(_LONG, sum(a * b for a, b in zip(row, col, strict=True)))) for col in columns]
                order = sorted((j for j in range(n) if c_ids[j] != vec_id), key=lambda j: (-scores[j], j))[:k]
                out.append((int(vec_id), c_ids[order], [scores[j] for j in order]))
    return out


def search(queries: DataFrame, vectors: DataFrame, k: int, *, scale: float | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows of ``vectors`` with the
    highest inner product for every row of ``queries`` (see module doc).  With
    ``scale`` a component x counts as floor(scale * x), else x must be whole."""

    def prepared(df: DataFrame) -> DataFrame:
        vector = F.col(f"`{vector_col}`").cast("array<double>")
        fine = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        taking_part = df.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{vector_col}`").isNotNull()).where(fine)
        return taking_part.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vector"))

    def dealt(df: DataFrame, groups: int, name: str, others: int, other: str) -> DataFrame:
        """Rows with their group, once for every group of the other side."""
        place = F.xxhash64(F.monotonically_increasing_id())
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
        return df.select("id", "vector", F.size("vector").alias("dim"), F.pmod(place, F.lit(groups)).alias(name)).withColumn(other, every)

    rows = cut(prepared(vectors), "vectors")
    asked = cut(prepared(queries).distinct(), "queries")
    n_rows, n_asked = rows.count(), asked.count()
    shards, blocks = max(1, -(-n_rows // TILE_ROWS)), max(1, -(-n_asked // TILE_QUERIES))

    def tile(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = best_of_tile(*_matrix(left, scale), *_matrix(right, scale), k)
        lists = [[{"neg": -s, "vec_id": int(v)} for v, s in zip(ids, scores, strict=True)] for _, ids, scores in found]
        shard = key[1].as_py()
        kind = pa.list_(pa.struct([("neg", pa.decimal128(20, 0)), ("vec_id", pa.int64())]))
        return pa.table({"query_id": pa.array([x[0] for x in found], pa.int64()), "shard": pa.array([shard] * len(found), pa.int64()), "best": pa.array(lists, kind)})

    ship(vectors.sparkSession)
    by = ("block", "shard", "dim")
    left = dealt(asked, blocks, "block", shards, "shard").groupBy(*by)
    right = dealt(rows, shards, "shard", blocks, "block").groupBy(*by)
    lists = left.cogroup(right).applyInArrow(tile, _LISTS)
    while True:
        merged = lists.groupBy("query_id", F.expr(f"shard div {FAN_IN}").alias("shard"))
        lists = merged.agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
        shards = -(-shards // FAN_IN)
        if shards <= 1:
            break
    return lists.select("query_id", F.posexplode("best").alias("place", "one")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), (-F.col("one.neg")).cast("long").alias("score")
    )


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector of ``embeddings``."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors.where(F.col("vec_id") % STEP == 0), vectors, TOP, scale=SCALE)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_dot_product(q.e, c.e), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
