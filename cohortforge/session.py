"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins carry no broadcast hints: Spark broadcasts a side only when its measured
# size (statistics before the run, shuffle sizes during it) is under the
# threshold, and falls back to a shuffled join, split on skew, above it.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # fact tables of this size are filtered by the people's keys as they are scanned
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    # shuffled rows are several times as large in memory: a task reads few of them, and a file's
    # columns are not taken for small because they are stored well
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.sources.fileCompressionFactor": "10.0",
    # what a stage was shuffled through goes from the disks when the stage is written
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # the JVM never compiles a method over 8000 bytes; wide stages with many result
    # patterns would exceed that and stay interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


PARTITION_BYTES = 2 << 20  # of the inputs' files, a shuffle partition


def partition_by_size(spark: SparkSession, size: int) -> None:
    """Shuffle into partitions that grow in number with the inputs' bytes; adaptive runs join small ones."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(least, size // PARTITION_BYTES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))


def keep_dealt(spark: SparkSession) -> None:
    """Rows that are dealt out by one of a join's keys stay so: for tables in buckets by such a key."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def configure(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive settings the plans rely on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark
