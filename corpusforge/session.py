"""Session settings that suit the jobs of this package."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: merge small shuffle partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The text steps stream row by row, so large scan tasks are safe, and fewer of them
    # mean fewer blocks in the one shuffle that follows.
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


def build_session(app_name: str = "corpusforge", master: str | None = None, **settings: str) -> SparkSession:
    """Start or get a session.  Keyword names use ``__`` for the dots of a setting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
