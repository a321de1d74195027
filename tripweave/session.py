"""A Spark session with the settings the engine counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tripweave", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution on (coalesced and skew-split shuffles), UTC, no web page.

    Trip rows are narrow and cost more time than bytes, so a partition counts as skewed from 64 MB
    on (Spark's own mark is 256 MB).

    Pass Spark settings as keyword arguments with ``__`` for ``.``, e.g.
    ``spark__sql__shuffle__partitions="8"``.  On a cluster set the initial partition number high
    (``spark__sql__adaptive__coalescePartitions__initialPartitionNum``) and let AQE coalesce.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64MB")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
