"""Ingesting series: plan, fetch, check the window, merge, and record, one series a unit of work."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline import registry, schemas
from tideline.operators import profile, quality, silver
from tideline.plans import planner
from tideline.sources.lake import Lake
from tideline.sources.payloads import ON_LATE

#: Gives the observations that a plan asks for, in the stored schema.
Fetcher = Callable[[registry.Series, planner.Fetch], DataFrame]


@dataclass
class Outcome:
    """What a run over several series did: failures don't stop the others."""

    done: dict[str, dict[str, int]] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)


class Ingestion:
    """Runs of registered series into a lake."""

    def __init__(self, lake: Lake, fetch: Fetcher, clock: Callable[[], datetime] = lambda: datetime.now(UTC), overlap_days: int = planner.OVERLAP_DAYS, secrets: Sequence[str] = ()):
        self.lake, self.fetch, self.clock, self.overlap_days, self.secrets = lake, fetch, clock, overlap_days, [s for s in secrets if s]

    def run(self, series_id: str, today: date, reconcile: bool = False) -> dict[str, int]:
        """One series. What fails before its fetch leaves no record; what fails later is recorded as failed and raised again."""
        series = registry.series(series_id)
        table = self.lake.bronze[series.shape]
        where = {"provider": series.provider, "series_id": series.series_id}
        plan = planner.plan(series, table.newest(**where), today, reconcile, self.overlap_days)
        started, run_id = self.clock(), uuid.uuid4().hex
        try:
            fetched = self.fetch(series, plan)
            n_fetched = fetched.count()
            accepted = planner.apply_window(fetched, plan, ON_LATE[series.provider])
            n_accepted = accepted.count()

            def record(counts: dict[str, int]) -> None:
                self._record(series, plan, run_id, started, "success", n_fetched, n_accepted, counts)
                self._advance(series, plan, n_fetched, n_accepted, counts, table.newest(**where))

            return table.upsert(accepted, record, **where)
        except Exception as error:
            self._record(series, plan, run_id, started, "failed", 0, 0, {}, error)
            raise

    def run_many(self, series_ids: Sequence[str], today: date, reconcile: bool = False) -> Outcome:
        outcome = Outcome()
        for series_id in registry.selected(series_ids):
            try:
                outcome.done[series_id] = self.run(series_id, today, reconcile)
            except Exception as error:
                outcome.failed[series_id] = self._clean(f"{type(error).__name__}: {error}")
        return outcome

    def _clean(self, text: str) -> str:
        for secret in self.secrets:
            text = text.replace(secret, "***")
        return text[:500]

    def _record(self, series, plan, run_id, started, status, fetched, accepted, counts, error=None) -> None:
        row = (
            run_id, series.provider, series.series_id, plan.mode, plan.filter_start or plan.request_start, plan.request_end, fetched, accepted, counts.get("inserted", 0), counts.get("revised", 0), counts.get("months", 0), status, started, self.clock(),
            type(error).__name__ if error else None, self._clean(str(error)) if error else None,
        )
        rows = self.lake.spark.createDataFrame([row], schemas.RUNS)
        quality.require(quality.run_checks(rows), "run record")
        self.lake.runs.upsert(rows)

    def _advance(self, series, plan, fetched, accepted, counts, newest) -> None:
        """The series' state, after data and run record are written; the time of reconciling moves only with a reconcile."""
        known = self.lake.state.read().where((F.col("provider") == series.provider) & (F.col("series_id") == series.series_id)).first()
        now = self.clock()
        reconciled = now if plan.mode == "reconcile" else (known.last_reconcile_utc if known else None)
        row = (series.provider, series.series_id, now, newest, plan.filter_start or plan.request_start, plan.request_end, plan.mode, fetched, accepted, counts["inserted"] + counts["revised"], reconciled)
        self.lake.state.upsert(self.lake.spark.createDataFrame([row], schemas.STATE))


def build_silver(lake: Lake, series_ids: Sequence[str] = ()) -> dict[str, dict[str, int]]:
    """The long table from the stored observations of each series; a day that has vanished from them stays."""
    done = {}
    for series_id in registry.selected(series_ids):
        series = registry.series(series_id)
        rows = lake.bronze[series.shape].read(provider=series.provider, series_id=series.series_id)
        done[series_id] = lake.silver.upsert(silver.canonicalize(series, rows).select(*schemas.SILVER.fieldNames()), series_id=series_id)
    return done


def refresh_inventory(lake: Lake) -> DataFrame:
    """Counts what is stored of every registered series, and keeps the result."""
    parts = [t.read().select("series_id", "observation_date", F.col("_metadata.file_path").alias("file")) if t.newest() else None for t in lake.bronze.values()]
    parts = [p for p in parts if p is not None]
    rows = parts[0] if parts else lake.spark.createDataFrame([], "series_id string, observation_date date, file string")
    for p in parts[1:]:
        rows = rows.unionByName(p)
    lake.inventory.replace(profile.inventory(registry.registry_frame(lake.spark), rows, file="file"))
    return lake.inventory.read()


def select_inventory(inventory: DataFrame, series_ids: Sequence[str] = (), providers: Sequence[str] = ()) -> DataFrame:
    """Rows of some series and providers, all where none are named; unknown names raise."""
    for x in series_ids:
        registry.series(x)
    if unknown := set(providers) - set(registry.PROVIDERS):
        raise KeyError(f"unknown provider: {', '.join(sorted(unknown))}")
    rows = inventory.where(F.col("series_id").isin(*series_ids)) if series_ids else inventory
    return rows.where(F.col("provider").isin(*providers)) if providers else rows


def as_lines(inventory: DataFrame) -> DataFrame:
    """Tab-separated lines of an inventory."""
    return inventory.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in inventory.columns]).alias("line"))


def as_json(inventory: DataFrame) -> DataFrame:
    """Compact JSON objects of an inventory."""
    return inventory.select(F.to_json(F.struct(*inventory.columns), {"ignoreNullFields": "false"}).alias("line"))
