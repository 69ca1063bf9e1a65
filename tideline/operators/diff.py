"""Comparing an incoming table with an existing one by key, and merging the difference.

Values are compared null-safely, so a null that stays null is unchanged. Two rules on what is missing:
a lake keeps rows that an update doesn't mention; a replica deletes what its source no longer has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import all_of, months_of


def payload(df: DataFrame, keys: Sequence[str], ignored: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in {*keys, *ignored}]


def _existing(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(f"__old_{c}") for c in columns], F.lit(True).alias("__exists"))


def _same(columns: Sequence[str]) -> Column:
    return all_of([F.col(c).eqNullSafe(F.col(f"__old_{c}")) for c in columns])


def classify(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], ignored: Sequence[str] = ()) -> DataFrame:
    """Incoming rows with change_type: insert, unchanged or revision. Existing rows that don't come in are left out."""
    compared = payload(incoming, keys, ignored)
    joined = incoming.join(_existing(existing, keys, compared), list(keys), "left")
    kind = F.when(F.col("__exists").isNull(), "insert").when(_same(compared), "unchanged").otherwise("revision")
    return joined.withColumn("change_type", kind).select(*incoming.columns, "change_type")


def changed(classified: DataFrame) -> DataFrame:
    return classified.where("change_type <> 'unchanged'").drop("change_type")


def merge(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows whose keys don't change, and the inserts and revisions."""
    new = changed(classify(existing, incoming, keys))
    return existing.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def keep_when_same(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], kept: str, ignored: Sequence[str] = ()) -> DataFrame:
    """Incoming rows; where all other columns equal the existing row's, column `kept` keeps the existing value.

    So a row that is fetched again without change keeps the time at which it was first fetched.
    """
    compared = payload(incoming, keys, (*ignored, kept))
    joined = incoming.join(_existing(existing, keys, [*compared, kept]), list(keys), "left")
    same = F.col("__exists").isNotNull() & _same(compared)
    return joined.withColumn(kept, F.when(same, F.col(f"__old_{kept}")).otherwise(F.col(kept))).select(*incoming.columns)


def affected_months(new: DataFrame, day: str = "observation_date") -> DataFrame:
    """Distinct (year, month) of some rows."""
    year, month = months_of(F.col(day))
    return new.select(year.alias("year"), month.alias("month")).distinct()


def in_months(rows: DataFrame, months: DataFrame, day: str = "observation_date") -> DataFrame:
    """Rows, with their year and month, that lie in the given months."""
    year, month = months_of(F.col(day))
    return rows.withColumns({"year": year, "month": month}).join(months, ["year", "month"], "left_semi")


def delta(source: DataFrame, target: DataFrame, keys: Sequence[str], digest: str) -> DataFrame:
    """(keys, op) of every key on either side: insert, update, delete or unchanged, by digest."""
    a = source.select(*keys, F.col(digest).alias("__source"), F.lit(1).alias("__s"))
    b = target.select(*keys, F.col(digest).alias("__target"), F.lit(1).alias("__t"))
    op = F.when(F.col("__t").isNull(), "insert").when(F.col("__s").isNull(), "delete").when(F.col("__source").eqNullSafe(F.col("__target")), "unchanged").otherwise("update")
    return a.join(b, list(keys), "full").select(*keys, op.alias("op"))


def delta_counts(planned: DataFrame) -> DataFrame:
    """One row: inserted, updated, deleted, unchanged."""
    count = lambda op: F.count_if(F.col("op") == op)
    return planned.agg(count("insert").alias("inserted"), count("update").alias("updated"), count("delete").alias("deleted"), count("unchanged").alias("unchanged"))


def apply_delta(source: DataFrame, target: DataFrame, planned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after the planned delta: inserts and updates from the source, the unchanged from itself."""
    new = source.join(planned.where("op in ('insert', 'update')").select(*keys), list(keys), "left_semi")
    old = target.join(planned.where("op = 'unchanged'").select(*keys), list(keys), "left_semi")
    return old.unionByName(new)


def difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, side) of rows by which two keyed tables differ: only_left, only_right or different."""
    values = payload(left, keys)
    a = left.select(*keys, *values, F.lit(1).alias("__l"))
    b = _existing(right, keys, values)
    side = F.when(F.col("__exists").isNull(), "only_left").when(F.col("__l").isNull(), "only_right").when(~_same(values), "different")
    return a.join(b, list(keys), "full").select(*keys, side.alias("side")).where("side is not null")


def equal_tables(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> bool:
    return difference(left, right, keys).isEmpty()


def without(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of left that right doesn't have."""
    return left.select(*keys).distinct().join(right.select(*keys), list(keys), "left_anti")


def shared_keys(sets: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """(keys, n) of keys in more than one of some sets of keys; empty if they are disjoint."""
    every = [s.select(*keys).distinct() for s in sets]
    union = every[0]
    for s in every[1:]:
        union = union.unionByName(s)
    return union.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
