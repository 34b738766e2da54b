"""A Spark session with the settings that the library's results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "basketry", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling; everything else is the cluster's."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    builder = builder.config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
