"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Every value is a Spark default or safe on any cluster; the partition count
# is only the starting point that adaptive execution coalesces from.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # Recording the call site of every column costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_SHUFFLE_TARGET = 128 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Initial shuffle partitions for jobs that move about this much data."""
    return max(2 * cores, -(-shuffled_bytes // _SHUFFLE_TARGET))


def build_session(
    app: str, shuffled_bytes: int | None = None, cores: int = 8, **overrides: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffled_bytes is not None:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(shuffle_partitions(shuffled_bytes, cores)),
        )
    for key, value in overrides.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
