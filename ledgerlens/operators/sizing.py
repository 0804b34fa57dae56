"""Checked broadcasts: a side is broadcast only after its bytes were counted."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 128 * 1024 * 1024

def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in memory: a word for NULLs and for each column, and text padded to words."""
    text = [field.name for field in df.schema if isinstance(field.dataType, (T.StringType, T.BinaryType))]
    padded = [f"(coalesce(octet_length(`{name}`), 0) + 7) div 8 * 8" for name in text]
    return F.expr(" + ".join([f"{8 * (2 + len(df.columns) // 64 + len(df.columns))}L", *padded]))


def measured_bytes(df: DataFrame) -> int:
    """Size of `df` once broadcast for a hash join, from one distributed aggregate; only the total reaches the driver.

    The hash map holds each row twice, as key and as value (the key may be shorter; it is counted whole), 24
    bytes around them, and at most 64 bytes of slots per row, at least 4 KiB, in pages of which the last may be empty.
    """
    rows, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    if not rows:
        return 0
    page = df.sparkSession._jvm.org.apache.spark.SparkEnv.get().memoryManager().pageSizeBytes()
    return 2 * size + 88 * rows + page + 4096


def broadcast_within(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame | None:
    """`df` marked for broadcast when it is measured to fit `limit`, else None."""
    return F.broadcast(df) if limit > 0 and measured_bytes(df) <= limit else None


def reliable_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables, as named by the cluster.

    A machine-local folder is only ever used in local mode, where it is shared by definition.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.gettempdir()


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Creates a folder that is removed when the driver ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    system.deleteOnExit(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, which outlives executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(reliable_dir(df.sparkSession))
    return df.checkpoint()
