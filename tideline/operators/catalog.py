"""Rules of the snapshot catalog as expressions and rewrites of its table.

A snapshot is building, complete or failed; at most one is current. Selecting, promoting, failing and
marking for removal are each one DataFrame expression over the catalog, whatever its size.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline import schemas
from tideline.functions.scalars import all_of

PATHS = ("data_path", "build_manifest_path", "plot_path")
_RESULTS = ("min_timestamp", "max_timestamp", "row_count", *PATHS, "pruned_at_utc")


class CatalogError(LookupError):
    """No snapshot, or none that may be used."""


def has_paths() -> Column:
    return all_of([F.coalesce(F.col(c) != "", F.lit(False)) for c in PATHS])


def selectable() -> Column:
    """Complete, with its time and all its files, and not pruned."""
    return (F.col("status") == "complete") & F.col("completed_at_utc").isNotNull() & F.col("pruned_at_utc").isNull() & has_paths()


def compatible(schema_version: int, feature_version: int) -> Column:
    return (F.col("schema_version") == schema_version) & (F.col("feature_version") == feature_version)


def current(catalog: DataFrame) -> DataFrame:
    return catalog.where("current")


def resolve_strict(catalog: DataFrame, schema_version: int, feature_version: int) -> DataFrame:
    """The current snapshot, if it is selectable and compatible; else no row."""
    return current(catalog).where(selectable() & compatible(schema_version, feature_version))


def resolve_latest(catalog: DataFrame, schema_version: int, feature_version: int) -> DataFrame:
    """The current snapshot if it may be used, else the newest that may; else no row."""
    usable = catalog.where(selectable() & compatible(schema_version, feature_version))
    return usable.orderBy(F.desc("current"), F.desc("completed_at_utc"), F.desc("build_id")).limit(1)


def require_one(resolved: DataFrame, what: str):
    rows = resolved.limit(2).collect()
    if len(rows) != 1:
        raise CatalogError(f"{what}: {'no' if not rows else 'more than one'} snapshot")
    return rows[0]


def broken_rules(catalog: DataFrame) -> DataFrame:
    """(check, violations) of the catalog's invariants."""
    from tideline.operators.quality import duplicate_members, violations

    all_paths = has_paths()
    no_paths = all_of([F.col(c).isNull() for c in PATHS])
    checks = {
        "unknown_status": ~F.col("status").isin("building", "complete", "failed"),
        "negative_count": (F.col("row_count") < 0) | (F.col("schema_version") < 0) | (F.col("feature_version") < 0),
        "bounds_out_of_order": F.col("max_timestamp") < F.col("min_timestamp"),
        "completed_before_started": F.col("completed_at_utc") < F.col("started_at_utc"),
        "paths_incomplete": ~(all_paths | no_paths),
        "current_not_usable": F.col("current") & ~F.coalesce(selectable(), F.lit(False)),
        "complete_without_time": (F.col("status") == "complete") & F.col("completed_at_utc").isNull(),
    }
    several = catalog.agg(F.greatest(F.count_if("current") - 1, F.lit(0)).alias("violations")).select(F.lit("several_current").alias("check"), "violations")
    twice = duplicate_members(catalog, ["build_id"]).select(F.lit("duplicate_build_id").alias("check"), F.col("duplicate_rows").alias("violations"))
    return violations(catalog, checks).unionByName(several).unionByName(twice)


def _rewrite(catalog: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    types = {f.name: f.dataType for f in schemas.CATALOG}
    return catalog.withColumns({c: F.when(where, v.cast(types[c])).otherwise(F.col(c)) for c, v in values.items()})


def fail_stale(catalog: DataFrame, at: datetime, build_id: str | None = None) -> DataFrame:
    """Snapshots still building, or only the given one, become failed, without results."""
    stale = (F.col("status") == "building") & ~F.col("current")
    if build_id is not None:
        stale = stale & (F.col("build_id") == build_id)
    return _rewrite(catalog, stale, {"status": F.lit("failed"), "completed_at_utc": F.lit(at)} | {c: F.lit(None) for c in _RESULTS})


def promote(catalog: DataFrame, build_id: str, results: dict) -> DataFrame:
    """The building snapshot becomes complete and current, with its results; the one that was current no longer is."""
    chosen = F.col("build_id") == build_id
    values = {"status": F.lit("complete"), "pruned_at_utc": F.lit(None)} | {k: F.lit(v) for k, v in results.items()}
    return _rewrite(catalog, chosen, values).withColumn("current", chosen)


def excess(catalog: DataFrame, keep: int = 5) -> DataFrame:
    """Snapshots to prune: for each pair of versions the oldest beyond `keep`, never the current one."""
    if keep < 1:
        raise ValueError("at least one snapshot must be kept")
    held = catalog.where((F.col("status") == "complete") & F.col("pruned_at_utc").isNull() & has_paths())
    pair = Window.partitionBy("schema_version", "feature_version")
    counted = held.withColumn("__over", F.count("*").over(pair) - keep)
    oldest = Window.partitionBy("schema_version", "feature_version", "current").orderBy("completed_at_utc", "build_id")
    ranked = counted.withColumn("__rank", F.row_number().over(oldest))
    return ranked.where(~F.col("current") & (F.col("__rank") <= F.col("__over"))).drop("__over", "__rank")


def mark_pruned(catalog: DataFrame, at: datetime, keep: int = 5) -> DataFrame:
    """The catalog with the excess marked: their files' paths go and the time is set, before any file does."""
    chosen = excess(catalog, keep).select("build_id", F.lit(True).alias("__prune"))
    joined = catalog.join(chosen, "build_id", "left").withColumn("__prune", F.coalesce("__prune", F.lit(False)))
    values = {"pruned_at_utc": F.lit(at)} | {c: F.lit(None) for c in PATHS}
    return _rewrite(joined, F.col("__prune"), values).select(*catalog.columns)


def to_sweep(catalog: DataFrame) -> DataFrame:
    """Marked snapshots, whose files may go, in the order of their marking."""
    gone = all_of([F.col(c).isNull() for c in PATHS])
    return catalog.where((F.col("status") == "complete") & ~F.col("current") & F.col("pruned_at_utc").isNotNull() & gone).orderBy("pruned_at_utc", "build_id")
