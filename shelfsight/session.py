"""Session defaults for the jobs in this package."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks broadcast or sort-merge from measured sizes, splits
# skewed join partitions and merges small ones, so no operator hints a broadcast
# for a table that can grow.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "shelfsight", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or fetch) a session; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
