"""Interval versions from change events (type-2 history)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bool_flag
from ..session import written


def _anchor(anchor: datetime) -> Column:
    return F.lit(anchor.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def lead_within_key(
    df: DataFrame, key: str, ts: str, out: str, *, strategy: str = "range", partitions: int | None = None
) -> DataFrame:
    """``df`` plus ``out`` = ``lead(ts) over (partition by key order by ts)``
    and a boolean ``__first`` marking each key's first row.

    ``strategy="window"`` is the plain window: every row of a key goes to
    one task, so a key (or a key and day) owning a large share of the rows
    would stall the job.  ``strategy="range"`` (default) has no such group:

    1. range-partition on ``(key, ts)``: partition ``i`` is a contiguous
       slice of the global order and a hot key is spread over many slices;
       the slices are tagged, written and read back (range boundaries are
       sampled, so they must not be computed twice);
    2. ``lead``/``row_number`` per ``(slice, key)`` - no group is larger
       than one slice;
    3. the only cross-slice facts - the first ``(key, ts)`` of the next
       non-empty slice and the last key of the previous one - come from a
       table with one row per slice, bounded by the partition count and
       therefore broadcast.
    """
    if strategy == "window":
        w = Window.partitionBy(key).orderBy(ts)
        return df.withColumns({"__first": F.row_number().over(w) == 1, out: F.lead(ts).over(w)})
    if strategy != "range":
        raise ValueError(f"unknown strategy {strategy!r}")
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = written(
        df.repartitionByRange(n, F.col(key), F.col(ts))
        .sortWithinPartitions(key, ts)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id()),
        "slices",
    )
    # one row per non-empty slice: its first and last row in the global order
    ends = sliced.groupBy(F.col("__pid").alias("__e")).agg(
        F.min("__mid").alias("__m_first"), F.max("__mid").alias("__m_last")
    )
    at_end = (F.col("__pid") == F.col("__e")) & (
        (F.col("__mid") == F.col("__m_first")) | (F.col("__mid") == F.col("__m_last"))
    )
    marks = sliced.join(F.broadcast(ends), at_end).groupBy("__pid").agg(
        F.max_by(F.col(key), F.col("__mid") == F.col("__m_first")).alias("__first_key"),
        F.max_by(F.col(ts), F.col("__mid") == F.col("__m_first")).alias("__first_ts"),
        F.max_by(F.col(key), F.col("__mid") == F.col("__m_last")).alias("__last_key"),
    )
    order = Window.orderBy("__pid")  # over one row per slice: bounded by n
    edges = marks.select(
        F.col("__pid").alias("__e_pid"),
        F.lead("__first_key").over(order).alias("__next_key"),
        F.lead("__first_ts").over(order).alias("__next_ts"),
        F.lead("__pid").over(order).isNotNull().alias("__has_next"),
        F.lag("__last_key").over(order).alias("__prev_key"),
        F.lag("__pid").over(order).isNotNull().alias("__has_prev"),
    )
    w = Window.partitionBy("__pid", key).orderBy(F.col(ts), F.col("__mid"))
    local = sliced.withColumns({"__rn": F.row_number().over(w), "__next": F.lead(ts).over(w)})
    local = local.withColumn("__last", F.lead("__mid").over(w).isNull())
    j = local.join(F.broadcast(edges), F.col("__pid") == F.col("__e_pid"))
    continues = F.col("__has_next") & F.col("__next_key").eqNullSafe(F.col(key))
    started_before = F.col("__has_prev") & F.col("__prev_key").eqNullSafe(F.col(key))
    nxt = F.when(F.col("__last"), F.when(continues, F.col("__next_ts"))).otherwise(F.col("__next"))
    return j.select(
        *[F.col(c) for c in df.columns],
        ((F.col("__rn") == 1) & ~started_before).alias("__first"),
        nxt.alias(out),
    )


def interval_versions(
    events: DataFrame,
    key: str,
    ts: str,
    *,
    anchor: datetime | None = None,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    is_current: str = "is_current",
    strategy: str = "range",
) -> DataFrame:
    """One version per event: valid on ``[ts, next ts of the same key)``.

    ``events`` must hold one row per ``(key, ts)``.  With ``anchor`` the first
    version of every key starts at that instant instead of its own ``ts`` so
    facts earlier than the first captured event still resolve.  The ``lead``
    is skew-safe (see ``lead_within_key``).
    """
    out = lead_within_key(events, key, ts, valid_to, strategy=strategy)
    start = F.col(ts)
    if anchor is not None:
        start = F.when(F.col("__first"), _anchor(anchor)).otherwise(F.col(ts))
    return out.withColumns({valid_from: start, is_current: bool_flag(F.col(valid_to).isNull())}).drop("__first")
