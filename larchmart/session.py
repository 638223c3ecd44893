"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "larchmart") -> SparkSession:
    """Session used by tests and the bench (UI off, AQE on, UTC, ANSI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LARCHMART_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only a local-mode session
    without one (tests, the local bench, the driver's smoke run) gets a fresh
    folder of its own; on a cluster an unset directory is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext (e.g. Spark Connect)
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this job") from None
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) for this job")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="larchmart-ckpt-"))
    return sc.getCheckpointDir()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared work folder and read back: cut from its lineage
    like by a reliable checkpoint, but computed once and in compressed columns."""
    path = f"{work_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
