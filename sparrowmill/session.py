"""Session defaults the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Executor sizing and partition counts stay with the cluster; these only fix semantics and let
# adaptive execution size, merge and split partitions from the bytes it really sees.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.cbo.enabled": "true",
    # Collected lists, a few entries each, keep hashing up to so many groups a task, instead of 128.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "sparrowmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; ``conf`` uses ``__`` for dots and wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{key.replace("__", "."): value for key, value in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
