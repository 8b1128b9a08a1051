"""Session construction for tests, the bench and local use.

On a cluster the caller owns the session; operators never change session
configuration.  ``build_session`` only sets what a local run needs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "roadlens", extra: dict | None = None) -> SparkSession:
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        # remove checkpoint files once the checkpointed data is unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
