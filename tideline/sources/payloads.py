"""Providers' payloads as typed observations.

Each reader takes the path of landed files and gives observation_date with either a value or the prices
of a bar. Files are read and parsed by Spark; what must not pass is counted in one aggregate, and the
reader raises with its name. Two policies stand side by side for bad bars: a full file drops them beside
good ones, an answer to a request fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline import schemas
from tideline.functions.scalars import any_null, finite, first_date, missing, number, valid_bar
from tideline.operators.quality import duplicate_keys, violations
from tideline.registry import Series

# Fixed values, as all column names and date formats below: what the providers' files have.
PRICES = ("open", "high", "low", "close")
_DAY = "observation_date"
_CHART = """struct<chart: struct<error: string, result: array<struct<timestamp: array<bigint>,
    indicators: struct<quote: array<struct<open: array<string>, high: array<string>, low: array<string>, close: array<string>>>>>>>>"""


class PayloadError(ValueError):
    """A payload that can't be taken."""


def _no(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """df if no row fulfils a check and no day occurs twice; else raises."""
    if checks and (bad := [f"{r.check}: {r.violations}" for r in violations(df, checks).where("violations > 0").collect()]):
        raise PayloadError("; ".join(bad))
    if not duplicate_keys(df, [_DAY]).isEmpty():
        raise PayloadError("a day occurs twice")
    return df


def delimiter(first_line: str) -> str:
    return next((c for c in ";\t" if c in first_line), ",")


def delimited(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """A delimited file with a header, all columns as text under trimmed upper-case names; no columns if it is empty."""
    if separator is None:
        head = spark.read.text(path).head(1)
        separator = delimiter(head[0].value if head else "")
    raw = spark.read.csv(path, header=True, sep=separator, inferSchema=False)
    return raw.toDF(*[c.strip().upper() for c in raw.columns])


def _column(df: DataFrame, names: Sequence[str]) -> Column:
    """The first of some names that the table has."""
    for name in names:
        if name in df.columns:
            return F.col(f"`{name}`")
    raise PayloadError(f"no column {' or '.join(names)}")


def ohlc_csv(spark: SparkSession, path: str) -> DataFrame:
    """Bars of a full file: DATE as MM/dd/yyyy or ISO; rows without a date or a number fail, invalid bars are dropped."""
    raw = delimited(spark, path, ",")
    day = first_date(F.trim(_column(raw, ["DATE"])), ("MM/dd/yyyy", "yyyy-MM-dd"))
    bars = raw.select(day.alias(_DAY), *[number(_column(raw, [c.upper()])).alias(c) for c in PRICES])
    _refuse(bars.where(any_null(bars.columns)), "a row lacks its date or a price")
    good = bars.where(valid_bar(*map(F.col, PRICES)))
    if good.isEmpty():
        raise PayloadError("no valid bar")
    return _no(good, {})


def _refuse(bad: DataFrame, why: str) -> None:
    if not bad.isEmpty():
        raise PayloadError(why)


def scalar_text(spark: SparkSession, path: str) -> DataFrame:
    """Values of a file delimited by ; tab or comma, under several names for its two columns and in three date formats."""
    raw = delimited(spark, path)
    day = first_date(F.trim(_column(raw, ["DATE", "TIME_PERIOD"])), ("yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy"))
    rows = raw.select(day.alias(_DAY), number(_column(raw, ["V2TX", "OBS_VALUE", "VALUE", "INDEXVALUE", "CLOSE"])).alias("value"))
    return _no(rows, {"no date": F.col(_DAY).isNull(), "no finite value": ~finite(F.col("value"))})


def sdmx_csv(spark: SparkSession, path: str) -> DataFrame:
    """TIME_PERIOD and OBS_VALUE; missing values are dropped, malformed ones fail, an empty file has no rows."""
    raw = delimited(spark, path, ",")
    if not raw.columns:
        return empty(spark, "scalar")
    rows = raw.select(first_date(_column(raw, ["TIME_PERIOD"]), ("yyyy-MM-dd",)).alias(_DAY), F.trim(_column(raw, ["OBS_VALUE"])).alias("text"))
    return _scalars(rows)


def _scalars(rows: DataFrame) -> DataFrame:
    bad = ~missing(F.col("text")) & ~finite(number(F.col("text")))
    _no(rows, {"no date": F.col(_DAY).isNull(), "no finite value": bad})
    return rows.where(~missing(F.col("text"))).select(_DAY, number(F.col("text")).alias("value"))


def _json(spark: SparkSession, path: str, schema: str, required: str) -> DataFrame:
    """Whole files as one parsed column `j`; files that aren't JSON or lack the required part fail."""
    texts = spark.read.text(path, wholetext=True)
    _refuse(texts.where(F.get_json_object("value", required).isNull()), f"no {required[2:]} in the payload")
    return texts.select(F.from_json("value", schema).alias("j"))


def chart_json(spark: SparkSession, path: str) -> DataFrame:
    """Bars from parallel vectors; days without any price are skipped, and everything else must be a valid bar."""
    chart = _json(spark, path, _CHART, "$.chart").select("j.chart.*")
    _refuse(chart.where(F.col("error").isNotNull()), "the provider reports an error")
    first = chart.select(F.get("result", F.lit(0)).alias("r")).where("r is not null").select(F.coalesce("r.timestamp", F.array().cast("array<bigint>")).alias("at"), F.get("r.indicators.quote", F.lit(0)).alias("q"))
    vectors = [F.coalesce(f"q.{c}", F.array().cast("array<string>")).alias(c) for c in PRICES]
    zipped = first.select("at", *vectors)
    _refuse(zipped.where(" or ".join(f"size({c}) <> size(at)" for c in PRICES)), "vectors differ in length")
    rows = zipped.select(F.explode(F.arrays_zip("at", *PRICES)).alias("z")).select(F.to_date(F.timestamp_seconds("z.at")).alias(_DAY), *[F.col(f"z.{c}").alias(f"t_{c}") for c in PRICES])
    rows = rows.where(" or ".join(f"t_{c} is not null" for c in PRICES)).select(_DAY, *[number(F.col(f"t_{c}")).alias(c) for c in PRICES])
    return _no(rows, {"no price": any_null(PRICES), "no valid bar": ~F.coalesce(valid_bar(*map(F.col, PRICES)), F.lit(False)), "no date": F.col(_DAY).isNull()})


def observations_json(spark: SparkSession, path: str) -> DataFrame:
    """Values from an array of dated texts; missing ones are dropped, malformed ones fail."""
    j = _json(spark, path, "observations array<struct<date: string, value: string>>", "$.observations")
    _refuse(j.where("j.observations is null"), "observations is no list")
    rows = j.select(F.explode("j.observations").alias("o")).select(first_date(F.col("o.date"), ("yyyy-MM-dd",)).alias(_DAY), F.trim("o.value").alias("text"))
    return _scalars(rows)


def empty(spark: SparkSession, shape: str) -> DataFrame:
    """No observations, typed."""
    values = ", ".join(f"{c} double" for c in (PRICES if shape == "ohlc" else ("value",)))
    return spark.createDataFrame([], f"{_DAY} date, {values}")


READERS = {"cboe": ohlc_csv, "stoxx": scalar_text, "yahoo": chart_json, "ecb": sdmx_csv, "fred": observations_json}
#: Providers whose answer is bound to a requested window fail on days outside it; the others always send everything.
ON_LATE = {"cboe": "drop", "stoxx": "drop", "yahoo": "fail", "ecb": "fail", "fred": "fail"}


def observations(spark: SparkSession, series: Series, path: str, fetched_at: datetime, source_url: str) -> DataFrame:
    """A landed payload of a series as rows of the stored schema."""
    if fetched_at.tzinfo is None:
        raise PayloadError("the time of fetching needs a time zone")
    rows = READERS[series.provider](spark, path)
    own = {"series_id": series.series_id, "provider": series.provider, "source_id": series.source_id, "source_url": source_url}
    rows = rows.withColumns({k: F.lit(v) for k, v in own.items()} | {"fetched_at_utc": F.lit(fetched_at).cast("timestamp")})
    return rows.select(*schemas.bronze(series.shape).fieldNames()).orderBy(_DAY)
