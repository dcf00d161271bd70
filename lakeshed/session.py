"""A session with the settings that the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(name: str = "lakeshed", **settings: str) -> SparkSession:
    """A session; ``settings`` come as spark_sql_shuffle_partitions="8"."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | {k.replace("_", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
