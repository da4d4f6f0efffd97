"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "134217728",
}


def builder(app: str = "tickloom") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    return b


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting (tests) falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tickloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def ensure_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df, name: str):
    """Write a table to the shared folder and read it back.

    Cuts the lineage between wide steps: later steps that read the table several times do not
    repeat the work, and a lost executor costs one task's re-read.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def round_tables(spark: SparkSession):
    """A function that stores the tables of a loop as ``materialise`` does; they are deleted at the end of the block.

    Stored tables also keep size estimates honest: those of a checkpoint are multiplied by every later self-join.
    """
    paths: list[str] = []

    def keep(df):
        paths.append(scratch(spark, "round"))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
