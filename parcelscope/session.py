"""Session settings the reports rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Shuffle partition counts are left to adaptive execution: it starts from
# spark.sql.shuffle.partitions of the cluster and merges or splits by bytes seen.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",  # sums and casts that overflow raise an error
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "parcelscope", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session; `extra` keys use `__` for the dots of a setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {key.replace("__", "."): value for key, value in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
