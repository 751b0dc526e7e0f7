"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the run-time work: it merges small shuffle partitions, splits
# partitions that one hot key makes too large, and broadcasts a join side only after the
# shuffle has shown that it is small enough.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Rank filters cut each group to its first k rows in the map tasks; Spark stops doing so beyond
    # this k.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
}


def build_session(app_name: str = "annoloom", master: str | None = None,
                  **overrides: str) -> SparkSession:
    """Session with :data:`SETTINGS`; ``overrides`` use ``__`` for the dots of a key."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    settings.update({k.replace("__", "."): v for k, v in overrides.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
