"""Session settings the operators are designed around."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the run-time part of skew handling: it splits shuffle
# partitions that hold a hot join key and turns a sort-merge join into a broadcast
# join only once the measured size of one side is below the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "nearspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
