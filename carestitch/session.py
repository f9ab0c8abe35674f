"""A Spark session with the settings the jobs rely on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Timestamps are read and written in UTC; AQE sizes partitions and splits hot ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def get_session(name: str, local: bool = False, extra: Mapping[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if local:
        builder = builder.master("local[*]").config("spark.driver.memory", "16g")
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
