"""A Spark session with the settings these jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits the join partition of a hot IMSI and sizes shuffles at run time; the
# calendar day of a record follows the session time zone.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.metricsEnabled": "true",
    "spark.ui.enabled": "false",
}


def open_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
