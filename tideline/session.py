"""A session with the settings the library relies on: UTC, dynamic partition overwrite, adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(app: str = "tideline", **extra: str) -> SparkSession:
    return SparkSession.builder.appName(app).config(map=SETTINGS | extra).getOrCreate()
