"""Checks of tables: each is a count of violations, and a table's checks are taken in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.scalars import finite
from tideline.registry import Series


class QualityError(ValueError):
    """A table breaks a rule; the text names the rules and how many rows break them."""


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check, violations): for each named condition the rows that fulfil it, in one aggregate."""
    sums = df.agg(*[F.coalesce(F.sum(F.when(bad, 1)), F.lit(0)).cast("long").alias(name) for name, bad in checks.items()])
    return sums.unpivot([], list(checks), "check", "violations")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n) of keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(duplicate_keys, duplicate_rows): keys that occur more than once, and all rows that have one."""
    return duplicate_keys(df, keys).agg(F.count("*").alias("duplicate_keys"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows"))


def not_increasing(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows that don't exceed the row before them in (by, column) order, which are repeats; without `by`, use it on one snapshot only."""
    w = Window.partitionBy(*by).orderBy(column)
    return df.withColumn("__before", F.lag(column).over(w)).where(F.col(column) <= F.col("__before")).drop("__before")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls) of some columns."""
    sums = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return sums.unpivot([], list(columns), "column_name", "nulls")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    if missing := missing_columns(df, required):
        raise QualityError(f"missing columns: {', '.join(missing)}")


def require(checked: DataFrame, what: str) -> None:
    """Raises if any check of a (check, violations) table has violations."""
    if bad := [f"{r.check} ({r.violations})" for r in checked.where("violations > 0").collect()]:
        raise QualityError(f"{what}: {', '.join(bad)}")


def _with_duplicates(checked: DataFrame, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return checked.unionByName(duplicate_members(df, keys).select(F.lit("duplicate_key").alias("check"), F.col("duplicate_rows").alias("violations")))


def bronze_checks(df: DataFrame, series: Series, values: Sequence[str]) -> DataFrame:
    """Identity, non-null days, unique keys and finite values of one series' observations."""
    same = lambda c, x: F.col(c).isNull() | (F.col(c) != x)
    checks = {
        "series_id": same("series_id", series.series_id),
        "provider": same("provider", series.provider),
        "source_id": same("source_id", series.source_id),
        "observation_date_null": F.col("observation_date").isNull(),
        **{f"{c}_not_finite": ~finite(F.col(c).cast("double")) for c in values},
    }
    return _with_duplicates(violations(df, checks), df, ["series_id", "observation_date"])


def silver_checks(df: DataFrame) -> DataFrame:
    """What features need of the long table: days, finite values, unique keys."""
    checks = {"series_id_null": F.col("series_id").isNull(), "observation_date_null": F.col("observation_date").isNull(), "value_not_finite": ~finite(F.col("value"))}
    return _with_duplicates(violations(df, checks), df, ["series_id", "observation_date"])


def wide_checks(df: DataFrame, key: str = "timestamp_m1") -> DataFrame:
    """What a snapshot needs: a unique, non-null key, and numbers that are null or finite."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    checks = {f"{key}_null": F.col(key).isNull()} | {f"{c}_not_finite": F.col(c).isNotNull() & ~finite(F.col(c)) for c in doubles}
    return _with_duplicates(violations(df, checks), df, [key])


def run_checks(runs: DataFrame) -> DataFrame:
    """Consistency of ingestion runs: counts, times, and that a failed run wrote nothing."""
    counts = ("fetched_rows", "accepted_rows", "inserted_rows", "revised_rows", "written_partitions")
    writes = F.col("inserted_rows") + F.col("revised_rows") + F.col("written_partitions")
    checks = {
        "run_id_empty": F.coalesce(F.trim("run_id"), F.lit("")) == "",
        **{f"{c}_negative": F.col(c) < 0 for c in counts},
        "completed_before_started": F.col("completed_at_utc") < F.col("started_at_utc"),
        "failed_with_writes": (F.col("status") == "failed") & (writes != 0),
    }
    return _with_duplicates(violations(runs, checks), runs, ["run_id"])
