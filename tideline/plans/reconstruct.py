"""Rebuilding everything from the sources in twelve guarded steps, each with a durable mark, so that a run that was killed goes on after the last step that passed."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import UTC, date, datetime

from tideline import registry
from tideline.operators import diff, serving
from tideline.plans import daily, ingest, planner
from tideline.plans.publish import Publisher
from tideline.plans.serve import KEY, Sync, SyncError
from tideline.sources.lake import Files

#: The steps in order. Nothing is changed before the first four have passed.
STEPS = ("maintenance", "locks", "endpoint", "backup", "reconcile", "silver", "gold", "schema", "publication", "verification", "replay", "weekly")


class Journal:
    """Marks of passed steps: a file each, published whole. What is marked out of order raises."""

    def __init__(self, files: Files, folder: str = "reconstruction"):
        self.files, self.folder = files, files.path(folder)

    def _file(self, step: str) -> str:
        return f"{self.folder}/{STEPS.index(step):02d}-{step}"

    def passed(self) -> dict[str, object]:
        """Results by step, in order."""
        names = [n for n in self.files.names(self.folder) if not n.startswith("_")]
        found = {n.split("-", 1)[1]: json.loads(self.files.read(f"{self.folder}/{n}")) for n in names}
        if tuple(found) != STEPS[: len(found)]:
            raise SyncError("the marks of a reconstruction aren't its first steps")
        return found

    def mark(self, step: str, result: object) -> None:
        if step != STEPS[len(self.passed())]:
            raise SyncError(f"{step} isn't the next step")
        if not self.files.publish(self._file(step), json.dumps(result, default=str, sort_keys=True)):
            raise SyncError(f"another run has done {step}")

    def close(self) -> None:
        self.files.delete(self.folder)


class Reconstruction:
    """The steps over a lake and a replica. Daily runs are refused from the first step until the last one has passed."""

    def __init__(self, ingestion: ingest.Ingestion, publisher: Publisher, sync: Sync, today: date, series: Sequence[str] = (), clock: Callable[[], datetime] = lambda: datetime.now(UTC)):
        self.ingestion, self.publisher, self.sync, self.today, self.clock = ingestion, publisher, sync, today, clock
        self.lake, self.series = publisher.lake, registry.selected(series)
        self.journal = Journal(self.lake.files)

    def run(self, execute: bool = False) -> list[dict]:
        """A report of the steps in order, which ends with the first that fails. Without execute nothing is done or marked."""
        passed, report = self.journal.passed(), []
        for step in STEPS:
            if step in passed:
                report.append({"step": step, "status": "PASSED BEFORE", "result": passed[step]})
            elif not execute:
                report.append({"step": step, "status": "PLANNED"})
            else:
                try:
                    result = getattr(self, f"_{step}")()
                    self.journal.mark(step, result)
                except Exception as error:
                    return [*report, {"step": step, "status": "FAIL", "result": type(error).__name__}]
                report.append({"step": step, "status": "PASS", "result": result})
        if execute:
            self.journal.close()
            self.lake.files.delete(daily.maintenance(self.lake))
        return report

    def _maintenance(self) -> str:
        began = self.clock().isoformat()
        self.lake.files.write(daily.maintenance(self.lake), began)
        return began

    def _locks(self) -> str:
        with self.sync.replica.locked(self.clock):
            return "free"

    def _endpoint(self) -> int:
        return self.sync.replica.digests().count()

    def _backup(self) -> str | None:
        """A copy of the replica's rows, read back and compared by digest."""
        rows = self.sync.replica.rows()
        if rows is None or rows.isEmpty():
            return None
        path = self.lake.files.path("backups", self.clock().astimezone(UTC).strftime("%Y%m%dT%H%M%SZ"))
        rows.write.parquet(path)
        if not diff.equal_tables(serving.digests(self.lake.spark.read.parquet(path)), serving.digests(rows), [KEY]):
            raise SyncError("the backup isn't the replica")
        return path

    def _reconcile(self) -> dict:
        return daily.require_all(self.ingestion.run_many(self.series, self.today, reconcile=True)).done

    def _silver(self) -> dict:
        for table in self.lake.bronze.values():
            table.check_files()
        done = ingest.build_silver(self.lake, self.series)
        self.lake.silver.check_files()
        return done

    def _gold(self) -> str:
        self.publisher.reconcile()
        return daily.build_gold(self.publisher).build_id

    def _schema(self) -> list[str]:
        replica = self.sync.replica
        done = replica.migrate(self.clock) if hasattr(replica, "migrate") else []
        if hasattr(replica, "violations") and not replica.violations().isEmpty():
            raise SyncError("the replica's tables break their contract")
        return done

    def _publication(self) -> dict:
        return vars(self.sync.run(afresh=True))

    def _verification(self) -> dict:
        report = self.sync.verify()
        if report["status"] != "PASS":
            raise SyncError(f"verification failed: {', '.join(report['failed'])}")
        return report

    def _replay(self) -> dict:
        again = self.sync.run()
        if again.inserted + again.updated + again.deleted:
            raise SyncError("a second run changes the replica")
        return vars(again)

    def _weekly(self) -> list[str]:
        """The weekly run must have a plan for every series."""
        newest = lambda s: self.lake.bronze[s.shape].newest(provider=s.provider, series_id=s.series_id)
        return [planner.plan(s, newest(s), self.today, True, self.ingestion.overlap_days).mode for s in map(registry.series, self.series)]
