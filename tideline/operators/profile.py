"""What tables hold: bounds, inventory, coverage, statistics and signatures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bounds(df: DataFrame, column: str = "observation_date", by: Sequence[str] = ()) -> DataFrame:
    """Least and greatest value, null without rows; by some columns or over all."""
    return df.groupBy(*by).agg(F.min(column).alias("minimum"), F.max(column).alias("maximum"))


def inventory(registry: DataFrame, bronze: DataFrame, keys: Sequence[str] = ("series_id", "observation_date"), file: str | None = None) -> DataFrame:
    """For each registered series, also those without rows: day bounds, rows, rows in duplicate keys, and files.

    keys: series_id among them. file: a column that names each row's file, such as _metadata.file_path; without one, file_count is 0. A series has a file a month.
    """
    files = [F.collect_set(file).alias("files")] if file else []
    by_key = bronze.groupBy(*keys).agg(F.count("*").alias("n"), F.min("observation_date").alias("low"), F.max("observation_date").alias("high"), *files)
    counted = F.size(F.array_distinct(F.flatten(F.collect_set("files")))) if file else F.lit(0)
    found = by_key.groupBy("series_id").agg(
        F.min("low").alias("min_observation_date"), F.max("high").alias("max_observation_date"), F.sum("n").alias("row_count"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("duplicate_key_count"), counted.alias("file_count"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (
        registry.select("series_id", "provider")
        .join(found, "series_id", "left")
        .select("series_id", "provider", "min_observation_date", "max_observation_date", zero("row_count"), zero("duplicate_key_count"), zero("file_count"))
    )


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, coverage): the share of rows with a value."""
    shares = df.agg(*[(F.count(c) / F.greatest(F.count("*"), F.lit(1))).alias(c) for c in columns])
    return shares.unpivot([], list(columns), "feature", "coverage")


def statistics(long: DataFrame, name: str = "feature", value: str = "value") -> DataFrame:
    """(name, n, mean, minimum, maximum, bins) of each feature of a long table of values; bins are 5 to 30, by the root of n."""
    n = F.count(value)
    bins = F.least(F.lit(30), F.greatest(F.lit(5), F.floor(F.sqrt(n)))).cast("long")
    return long.groupBy(name).agg(n.alias("n"), F.avg(value).alias("mean"), F.min(value).alias("minimum"), F.max(value).alias("maximum"), bins.alias("bins"))


def histogram(long: DataFrame, name: str = "feature", value: str = "value") -> DataFrame:
    """(name, bin, n): equal bins from minimum to maximum, numbered from 1; the maximum is in the last, empty bins are left out."""
    stats = statistics(long, name, value).select(name, "minimum", "maximum", "bins")
    x = F.col(value)
    width = (F.col("maximum") - F.col("minimum")) / F.col("bins")
    place = F.when(F.col("maximum") == F.col("minimum"), F.lit(1)).otherwise(F.least(F.floor((x - F.col("minimum")) / F.nullif(width, F.lit(0.0))) + 1, F.col("bins")))
    return long.where(x.isNotNull()).join(stats, name).groupBy(name, place.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def leading_gap(long: DataFrame, name: str = "series_id", order: str = "observation_date", value: str = "value") -> DataFrame:
    """(name, rows_before_value): rows of each name before its first value."""
    first = F.min(F.when(F.col(value).isNotNull(), F.col(order))).over(Window.partitionBy(name))
    return long.withColumn("__first", first).groupBy(name).agg(F.count_if(F.col("__first").isNull() | (F.col(order) < F.col("__first"))).alias("rows_before_value"))


def signature(silver: DataFrame, columns: Sequence[str] = ("observation_date", "value")) -> DataFrame:
    """For each series: rows, day bounds, and a digest of its rows in day order.

    Rows are hashed first and a month's hashes are hashed together, so that what is gathered for a series is one line a month.
    """
    null = F.lit("\x00")
    line = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), null) for c in columns]), 256)
    rows = silver.select("series_id", "observation_date", F.date_format("observation_date", "yyyyMM").alias("__month"), line.alias("__line"))
    ordered = lambda at, x: F.sha2(F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct(at, x))), lambda r: r[x])), 256)
    months = rows.groupBy("series_id", "__month").agg(F.count("*").alias("n"), F.min("observation_date").alias("low"), F.max("observation_date").alias("high"), ordered("observation_date", "__line").alias("__digest"))
    return months.groupBy("series_id").agg(F.sum("n").alias("row_count"), F.min("low").alias("min_observation_date"), F.max("high").alias("max_observation_date"), ordered("__month", "__digest").alias("sha256"))
