"""Small files through Hadoop's file API: listings, and numbered records of which
each number is written once.

A publisher that wants record ``n + 1`` writes it under a name of its own and moves
it to the record's name; the move fails where that name exists, so of several
publishers one gets the number and the others read again.  A reader never sees half a
record.  HDFS and file systems with the same rename refuse an existing target; on a
local disk a hard link does.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession

RECORD = "record-"


def _open(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def listing(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """(path, bytes, time of change) of every file below ``path``; empty if there is none."""
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return ()
    files, found = fs.listFiles(where, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def _record(number: int) -> str:
    return f"{RECORD}{number:012d}.json"


def newest_record(spark: SparkSession, folder: str) -> tuple[int, dict | None]:
    """Number and content of the newest record; (0, None) without any."""
    fs, where = _open(spark, folder)
    if not fs.exists(where):
        return 0, None
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    numbers = [int(n[len(RECORD) : -len(".json")]) for n in names if n.startswith(RECORD) and n.endswith(".json")]
    if not numbers:
        return 0, None
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{_record(max(numbers))}"))
    try:
        return max(numbers), json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def add_record(spark: SparkSession, folder: str, number: int, content: dict) -> bool:
    """Write record ``number``; False if it exists (nothing is changed then)."""
    fs, where = _open(spark, folder)
    fs.mkdirs(where)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{_record(number)}")
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_{uuid.uuid4().hex}")
    out = fs.create(own, False)
    try:
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(own.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        return not fs.exists(target) and fs.rename(own, target)
    finally:
        fs.delete(own, False)
