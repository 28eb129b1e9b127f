"""Session settings the reports rely on; all are runtime SQL settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins may reuse a partitioning on part of their keys, so a join and the window after it share
# one shuffle on the player keys. AQE resizes partitions, switches joins by measured size and
# splits skewed join partitions, also where that costs another shuffle.
SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings. Shuffles start with at least three partitions per core, unless the
    session says otherwise; AQE merges the ones that turn out small. For shuffles of many
    terabytes set the number so that a partition holds a few hundred megabytes."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    if spark.conf.get(INITIAL_PARTITIONS, None) is None and int(spark.conf.get("spark.sql.shuffle.partitions")) < cores:
        spark.conf.set(INITIAL_PARTITIONS, str(3 * cores))
    return spark
