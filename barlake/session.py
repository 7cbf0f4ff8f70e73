"""Session builder with the settings this package is measured with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "barlake", master: str | None = None, **extra: str) -> SparkSession:
    """AQE with skew splitting and UTC timestamps; ``extra`` wins.

    On a cluster, leave ``master`` out and set partition counts there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        **extra,
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
