"""Session construction."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "settleflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    On a cluster leave ``master`` unset and let spark-submit provide it, together with
    ``spark.checkpoint.dir`` (a folder all executors can reach) and the number of shuffle
    partitions; adaptive execution coalesces small ones and splits skewed join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
