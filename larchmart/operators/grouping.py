"""Grouping by keys that nearly every row has to itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.group import GroupedData


def spread(df: DataFrame, *keys: str | Column) -> GroupedData:
    """``df.groupBy(*keys)`` behind a shuffle of the rows by the same keys.

    A plain ``groupBy`` aggregates in the map tasks first: where few rows share a key
    this moves no less, but every map task holds the keys of its whole split (or, for
    text minima, sorts it) and spills what does not fit.  Behind the shuffle a task
    holds the keys of one partition, whose size adaptive execution bounds."""
    return df.repartition(*keys).groupBy(*keys)
