"""Session settings the jobs are written for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows carry whole pages: small Arrow batches bound the memory of a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(master: str | None = None, name: str = "tessella", **extra: str) -> SparkSession:
    """A session with the settings above; `extra` wins over them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
