"""Observations of either shape as one long table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline import schemas
from tideline.operators import quality
from tideline.registry import Series


def canonical(bronze: DataFrame, shape: str, unit: str) -> DataFrame:
    """The projection alone: close becomes the value of a bar; a scalar has no open, high, low and close."""
    price = (lambda c: F.col(c).cast("double")) if shape == "ohlc" else (lambda c: F.lit(None).cast("double"))
    value = F.col("close" if shape == "ohlc" else "value").cast("double")
    return bronze.select("observation_date", "series_id", value.alias("value"), *[price(c).alias(c) for c in ("open", "high", "low", "close")], F.lit(unit).alias("unit"), "provider", "source_id", "fetched_at_utc")


def canonicalize(series: Series, bronze: DataFrame) -> DataFrame:
    """One series' observations after all checks; a table without columns gives an empty result."""
    if not bronze.columns:
        return bronze.sparkSession.createDataFrame([], schemas.SILVER)
    values = ("open", "high", "low", "close") if series.shape == "ohlc" else ("value",)
    quality.require_columns(bronze, [*schemas.bronze(series.shape).fieldNames()])
    quality.require(quality.bronze_checks(bronze, series, values), f"observations of {series.series_id}")
    return canonical(bronze, series.shape, series.unit).orderBy("observation_date")
