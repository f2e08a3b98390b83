"""A session with the settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "readloom") -> SparkSession:
    """On a cluster, leave master and shuffle_partitions unset: they are the cluster's to choose."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
