"""Spark session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time from the shuffle's real sizes.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tables kept between reports go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "Asia/Shanghai",
}


def build_session(app_name: str = "orderlens", **settings: str) -> SparkSession:
    """Session for the nightly job; ``settings`` win over the defaults here."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
