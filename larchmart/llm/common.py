"""Helpers shared by the corpus operators: tables, lineage cuts, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir

#: A word of a text, as every contract of this subpackage defines it.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a Python worker handles at once (a longer text is one chunk).
CHUNK_BYTES = 2 << 20

#: Bits of a filter that tells which rows may match some keys (false positives only),
#: and of one row of it.
FILTER_BITS = 1 << 24
FILTER_BLOCK = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder of the session."""
    return f"{work_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages start
    from the files, so neither a lost executor nor a second use recomputes it."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package's modules (once per context): a
    function that runs there is pickled by reference to its module."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="larchmart-code-")) / "larchmart_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def arrow_map(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package's modules at hand on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that would clash with added ones of these names."""
    low = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in low])


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in column ``text``
    (or a single row), so that what a worker holds does not depend on how many
    rows Arrow happens to put into a batch."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if batch.num_rows > start:
            yield batch.slice(start)


def _slot(key: Column) -> Column:
    return key.bitwiseAND(F.lit(FILTER_BITS - 1))


def slot_bits(keys: DataFrame) -> DataFrame:
    """at, bits: a bit per slot of the filter, whether one of the keys (``key``, a long)
    falls into it; FILTER_BITS bits in all, however many keys there are."""
    slot = _slot(F.col("key"))
    return keys.groupBy(F.shiftright(slot, 15).alias("at")).agg(F.bitmap_construct_agg(slot.bitwiseAND(F.lit(FILTER_BLOCK - 1))).alias("bits"))


def with_match(rows: DataFrame, key: Column, keys: DataFrame, name: str) -> DataFrame:
    """``rows`` with a flag ``name``: false only where ``key`` is none of the keys."""
    bits = keys.transform(slot_bits).withColumnRenamed("at", "__at").withColumnRenamed("bits", "__bits")
    at = _slot(key).bitwiseAND(F.lit(FILTER_BLOCK - 1))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    set_there = F.floor(byte / F.pow(F.lit(2), at % 8)).cast("int") % 2 == 1
    joined = rows.join(F.broadcast(bits), F.shiftright(_slot(key), 15) == F.col("__at"), "left")
    return joined.withColumn(name, F.coalesce(set_there, F.lit(False))).drop("__at", "__bits")


def may_match(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` falls into a slot of the keys: all that match, and some others."""
    return with_match(rows, key, keys, "__match").where("__match").drop("__match")
