"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

MIB = 1024 * 1024

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Splits hot partitions of joins and of rebalanced writes, merges small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A rebalanced write yields files of about this size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MIB),
    "spark.sql.files.maxPartitionBytes": str(128 * MIB),
    # Checkpoints of narrowed price lists go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Day-partitioned tables have thousands of folders; list many of them per task.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def build_session(app_name: str = "ledgerlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
