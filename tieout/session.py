"""A session for tests and the bench. On a cluster, jobs use the session they are given."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local(cores: str | int = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tieout")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Split a skewed join also where that costs one more shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
