"""Session settings the library is meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Time zone: load times are UTC. Debugging: capturing the call site of every Column costs more than
# planning does for long expressions. AQE is on by default in Spark 4 and is relied upon: it coalesces
# small partitions, splits skewed ones in joins, and broadcasts sides that turn out small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
