"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Call-site capture costs a round trip per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Salted joins must be spread over all of their keys, the salt included.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
