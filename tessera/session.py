"""Spark sessions with the settings the library's semantics rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Naive times are UTC, casts and arithmetic fail loudly, TIME and deep recursion are available.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.cteRecursionLevelLimit": "1000",
    "spark.sql.adaptive.enabled": "true",
}

#: Named connection profiles: settings on top of SETTINGS.
PROFILES: dict[str, dict[str, str]] = {"default": {}, "local": {"spark.master": "local[*]", "spark.sql.shuffle.partitions": "8"}}


def session(profile: str = "default", **settings: str) -> SparkSession:
    return SparkSession.builder.config(map=SETTINGS | PROFILES[profile] | settings).getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Applies SETTINGS to a running session."""
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark
