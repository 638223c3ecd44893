"""Global ranking without a single-partition window.

``F.ntile(n).over(Window.orderBy(...))`` (or a window partitioned by a
two-valued flag) moves every row to one task.  ``global_rank`` instead:

1. range-partitions the rows on the full sort order and sorts each
   partition, so partition ``i`` holds a contiguous slice of the order;
2. tags each row with its partition id and a position inside the
   partition, then writes them and reads them back (range
   boundaries are sampled, so a recomputation could re-slice the data);
3. counts rows per partition - a table with one row per partition, whose
   size is bounded by the partition count and is therefore broadcast;
4. adds the running offset of the preceding partitions to each position.

A hot sort value cannot collapse onto one task because the order always
ends with a unique tie-breaker supplied by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    *,
    rank_col: str = "_rank",
    total_col: str = "_total",
    partitions: int | None = None,
) -> DataFrame:
    """Append the 1-based position of each row in ``order`` and the row total."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = written(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id()),
        "ranked",
    )
    per_part = sliced.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__m0"))
    # One row per partition: a single-task window over it is bounded by n.
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "__pid",
        "__m0",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
        F.sum("__n").over(Window.partitionBy()).alias(total_col),
    )
    ranked = sliced.join(F.broadcast(offsets), "__pid")
    rank = (F.col("__off") + (F.col("__mid") - F.col("__m0")) + F.lit(1)).cast("long")
    return ranked.withColumn(rank_col, rank).drop("__pid", "__mid", "__m0", "__off")


def ntile_from_rank(rank: Column, total: Column, n: int) -> Column:
    """SQL NTILE(n) bucket of a 1-based ``rank`` among ``total`` rows.

    With ``q, r = divmod(total, n)`` the first ``r`` buckets hold ``q + 1``
    rows and the rest ``q``; with fewer rows than buckets each row is its own
    bucket.
    """
    q = F.floor(total / F.lit(n)).cast("long")
    r = (total - q * F.lit(n)).cast("long")
    big = r * (q + 1)
    ceil_div = lambda a, b: ((a + b - F.lit(1)) / b).cast("long")  # noqa: E731  (a, b > 0)
    return (
        F.when(q == 0, rank)
        .when(rank <= big, ceil_div(rank, q + 1))
        .otherwise(r + ceil_div(rank - big, q))
        .cast("int")
    )


def distributed_ntile(
    df: DataFrame,
    n: int,
    order: Sequence[Column],
    out: str,
    *,
    partitions: int | None = None,
) -> DataFrame:
    """``ntile(n) over (order by <order>)`` over the whole frame, distributed.

    ``order`` must be a total order (end it with a unique key) so the result
    is deterministic and equal to the SQL window function.
    """
    ranked = global_rank(df, order, rank_col="__rank", total_col="__total", partitions=partitions)
    return ranked.withColumn(out, ntile_from_rank(F.col("__rank"), F.col("__total"), n)).drop("__rank", "__total")
