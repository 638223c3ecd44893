import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from larchmart.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="larchmart-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="larchmart-test-ckpt-"))
    yield s


@pytest.fixture
def raw(spark):
    """raw(docs, ingested_at=...) -> raw table DataFrame (id, payload, _ingested_at)."""
    from pyspark.sql import functions as F

    def make(docs, ingested_at="2025-01-01 00:00:00"):
        rows = []
        for i, d in enumerate(docs):
            if isinstance(d, tuple):
                d, ts = d
            else:
                ts = ingested_at
            rows.append((i, d if isinstance(d, str) else json.dumps(d), ts))
        df = spark.createDataFrame(rows, "id long, payload string, ts string")
        return df.select("id", "payload", F.col("ts").cast("timestamp_ntz").alias("_ingested_at"))

    return make
