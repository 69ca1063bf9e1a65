"""Publishing snapshots: register, build, validate, promote in the catalog, then clean up.

The catalog alone says which snapshot counts. A promotion is one commit of the catalog's table, so a
reader sees the old current snapshot or the new one; what fails before it leaves a failed row and nothing
that anyone reads, what fails after it doesn't undo it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tideline import registry, schemas
from tideline.operators import catalog as C
from tideline.operators import features, profile, quality, serving
from tideline.sources.lake import Lake

DATASET = "features_daily"


def canonical_json(value: object) -> str:
    """Sorted keys, no spaces, ASCII, one line."""
    return json.dumps(value, ensure_ascii=True, separators=(",", ":"), sort_keys=True) + "\n"


def formula_parameters() -> dict[str, object]:
    """Everything that defines the features' values."""
    return {
        "deltas": {s: list(n) for s, n in features.DELTAS.items()},
        "zscore": {"window": features.ZSCORE, "deviation": "population", "series": list(features.VOLATILITY)},
        "momentum": {"lags_and_windows": [list(p) for p in features.MOMENTUM], "negative": "zero", "deviation": "population"},
        "returns": {"windows": list(features.RETURNS), "kind": "compounded, per cent", "invalid_step": "null"},
        "cross_series": sorted([*features.RATIOS, *features.SPREADS, *features.SLOPES]),
        "alignment": "same day only, nothing is filled or carried",
    }


def feature_set_sha256(frame: DataFrame) -> str:
    """Digest of versions, names and types in order, and parameters."""
    columns = [{"name": n, "type": t} for n, t in frame.dtypes]
    whole = {"columns": columns, "parameters": formula_parameters(), "schema_version": features.SCHEMA_VERSION, "feature_version": features.FEATURE_VERSION}
    return hashlib.sha256(canonical_json(whole).encode()).hexdigest()


def input_records(silver: DataFrame) -> list[dict]:
    """Signatures of the series that a snapshot is made from, in the registry's order; one missing raises."""
    found = {r.series_id: r for r in profile.signature(silver).collect()}  # one row a registered series
    if missing := [s for s in registry.SERIES if s not in found]:
        raise quality.QualityError(f"no observations of {', '.join(missing)}")
    return [{"series_id": s, "row_count": found[s].row_count, "min_date": str(found[s].min_observation_date), "max_date": str(found[s].max_observation_date), "sha256": found[s].sha256} for s in registry.SERIES]


class Publisher:
    def __init__(self, lake: Lake, clock: Callable[[], datetime] = lambda: datetime.now(UTC), keep: int = 5, after: Callable[[], None] | None = None, identity: str = ""):
        self.lake, self.clock, self.keep, self.after, self.identity = lake, clock, keep, after, identity
        self.root = lake.files.path("snapshots", f"dataset={DATASET}")

    def folder(self, build_id: str) -> str:
        return f"{self.root}/build_id={build_id}"

    def next_id(self) -> str:
        """The time in seconds; one that is taken raises, so no two snapshots share a folder."""
        build_id = self.clock().astimezone(UTC).strftime("%Y%m%dT%H%M%SZ")
        if self.lake.files.exists(self.folder(build_id)) or not self.lake.catalog.read().where(F.col("build_id") == build_id).isEmpty():
            raise FileExistsError(f"snapshot {build_id} exists")
        return build_id

    def reconcile(self) -> DataFrame:
        """What a crashed run left as building becomes failed."""
        catalog = self.lake.catalog.read()
        if not catalog.where("current and status = 'building'").isEmpty():
            raise C.CatalogError("the current snapshot is building; this needs a person")
        self._fail_stale()
        self.refresh_view()
        return self.lake.catalog.read()

    def _fail_stale(self, build_id: str | None = None) -> None:
        """Rows that are building, all or one, become failed."""

        def failed(now: DataFrame) -> DataFrame | None:
            stale = now.where("status = 'building'")
            if build_id is not None:
                stale = stale.where(F.col("build_id") == build_id)
            return None if stale.isEmpty() else C.fail_stale(now, self.clock(), *([] if build_id is None else [build_id]))

        self.lake.catalog.update(failed)

    def _promoted(self, now: DataFrame, build_id: str, results: dict) -> DataFrame:
        promoted = C.promote(now, build_id, results)
        quality.require(C.broken_rules(promoted), "catalog")
        return promoted

    def publish(self, frame: DataFrame, inputs: Sequence[dict] = ()) -> Row:
        """The new current snapshot's catalog row."""
        self.reconcile()
        build_id, started = self.next_id(), self.clock()
        row = (DATASET, build_id, "building", False, started, None, features.SCHEMA_VERSION, features.FEATURE_VERSION, *[None] * 7)
        self.lake.catalog.upsert(self.lake.spark.createDataFrame([row], schemas.CATALOG))
        try:
            results = self._build(frame, build_id, started, inputs)
            self.lake.catalog.update(lambda now: self._promoted(now, build_id, results))
        except BaseException:
            self._fail_stale(build_id)
            self.lake.files.delete(self.folder(build_id))
            raise
        self.refresh_view()
        if self.after:
            self.after()
        return C.require_one(C.current(self.lake.catalog.read()), "after publishing")

    def _build(self, frame: DataFrame, build_id: str, started: datetime, inputs: Sequence[dict]) -> dict:
        """Writes data, manifest and profile into the snapshot's new folder, reads them back and checks them."""
        spark, files, folder = self.lake.spark, self.lake.files, self.folder(build_id)
        if frame.columns != features.WIDE_COLUMNS:
            raise quality.QualityError("a snapshot has exactly the wide frame's columns in order")
        data = f"{folder}/data"
        frame.orderBy("timestamp_m1").coalesce(1).write.mode("errorifexists").parquet(data)
        stored = spark.read.parquet(data)
        quality.require(quality.wide_checks(stored), f"snapshot {build_id}")
        if stored.dtypes != frame.dtypes:
            raise quality.QualityError("the snapshot reads back with other types")
        bounds = serving.summary(stored).first()
        digested = serving.digests(stored)
        columns = features.WIDE_COLUMNS[1:]
        long = stored.select("timestamp_m1", *columns).unpivot(["timestamp_m1"], columns, "feature", "value")
        profiled = profile.statistics(long).join(profile.coverage(stored, columns), "feature").orderBy("feature")
        profiled.coalesce(1).write.parquet(f"{folder}/profile")
        manifest = {
            "dataset_id": DATASET, "build_id": build_id, "started_at_utc": started.astimezone(UTC).isoformat(), "schema_version": features.SCHEMA_VERSION, "feature_version": features.FEATURE_VERSION,
            "row_count": bounds.row_count, "columns": frame.columns, "feature_set_sha256": feature_set_sha256(stored), "data_sha256": serving.table_digest(digested), "inputs": list(inputs), "identity": self.identity,
        }
        files.create(f"{folder}/manifest.json", canonical_json(manifest))
        return {"completed_at_utc": self.clock(), "min_timestamp": bounds.min_timestamp, "max_timestamp": bounds.max_timestamp, "row_count": bounds.row_count, "data_path": data, "build_manifest_path": f"{folder}/manifest.json", "plot_path": f"{folder}/profile"}

    def refresh_view(self) -> None:
        """A JSON file at the dataset's root that describes the current snapshot; without one it goes."""
        path, row = f"{self.root}/current.json", C.current(self.lake.catalog.read()).first()
        if row is None:
            self.lake.files.delete(path)
        else:
            self.lake.files.write(path, canonical_json({k: v.isoformat() if isinstance(v, date) else v for k, v in row.asDict().items()}))

    def read(self, row: Row) -> DataFrame:
        """A snapshot's rows, from the path that its catalog row names."""
        return self.lake.spark.read.parquet(row.data_path)

    def validate(self, row: Row) -> DataFrame:
        """The snapshot's rows after its manifest, versions, bounds and digest have been compared with the catalog and the data."""
        if not row.data_path.startswith(self.folder(row.build_id) + "/"):
            raise quality.QualityError("the snapshot's path lies outside its folder")
        manifest = json.loads(self.lake.files.read(row.build_manifest_path))
        stored = self.read(row)
        bounds = serving.summary(stored).first()
        wanted = {"build_id": row.build_id, "schema_version": row.schema_version, "feature_version": row.feature_version, "row_count": bounds.row_count, "columns": stored.columns, "feature_set_sha256": feature_set_sha256(stored), "data_sha256": serving.table_digest(serving.digests(stored))}
        if wrong := sorted(k for k, v in wanted.items() if manifest.get(k) != v):
            raise quality.QualityError(f"snapshot {row.build_id} differs from its manifest in {', '.join(wrong)}")
        if (row.row_count, row.min_timestamp, row.max_timestamp) != tuple(bounds):
            raise quality.QualityError(f"snapshot {row.build_id} differs from the catalog")
        return stored

    def retain(self) -> tuple[list[str], list[str]]:
        """Marks what exceeds the number to keep, then removes the files of all that is marked; both can be repeated."""
        catalog = self.lake.catalog.read()
        marked = [r.build_id for r in C.excess(catalog, self.keep).orderBy("completed_at_utc", "build_id").select("build_id").collect()]
        if marked:
            self.lake.catalog.update(lambda now: C.mark_pruned(now, self.clock(), self.keep))
            self.refresh_view()
        swept = [r.build_id for r in C.to_sweep(self.lake.catalog.read()).select("build_id").collect()]
        for build_id in swept:
            self.lake.files.delete(self.folder(build_id))
        return marked, swept
