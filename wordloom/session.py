"""Session settings that the plans of this package rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Each of these is a default of recent Spark or a value the plans were checked with.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app: str = "wordloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
