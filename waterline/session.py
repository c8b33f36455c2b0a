"""Session settings the plans of this library rely on, and those that size its tasks."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime join choice, split of skewed join partitions, merge of small shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Asset and time tables are joined by broadcast up to this size and by shuffle above it.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Reads only the day partitions that a join needs.
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    # Snapshot times carry no zone; this fixes what zoned literals mean.
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder, shuffle_partitions: int) -> SparkSession.Builder:
    """Apply the settings. Start with about two shuffle partitions per 256 MB of shuffled facts.

    Adaptive execution merges partitions that turn out small, so err on the high side.
    """
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
