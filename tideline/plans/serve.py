"""A serving replica of the current snapshot: row-digest delta, applied under a lock, verified before it counts.

The replica is a folder of tables here: consumer rows, an index of row digests, and the state, which is
written last. A database takes the same delta in one transaction (see plans/database.py).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline import schemas
from tideline.operators import catalog as C
from tideline.operators import diff, features, serving
from tideline.plans.publish import DATASET, Publisher
from tideline.sources.lake import Files

KEY = serving.KEY


class SyncError(RuntimeError):
    """The replica must not be changed, or isn't what it should be; the text says why."""


#: A writer is done sooner than that.
LOCK_EXPIRY = timedelta(hours=12)


def _moment(text: str) -> datetime | None:
    try:
        return datetime.fromisoformat(text)
    except ValueError:
        return None


@dataclass(frozen=True)
class Synced:
    build_id: str
    inserted: int
    updated: int
    deleted: int
    unchanged: int


class Replica:
    def __init__(self, spark, root: str):
        self.spark, self.files = spark, Files(spark, root)

    @contextmanager
    def locked(self, clock: Callable[[], datetime] = lambda: datetime.now(UTC)):
        """One writer at a time: a lock file that must not exist yet, with a token of its writer. One older than LOCK_EXPIRY is of a
        writer that crashed: it is moved away, which only one of several writers can do, and only if it is still the one that was read.
        """
        path, now, token = self.files.path("lock"), clock(), uuid.uuid4().hex
        try:
            if self.files.exists(path):
                self._take_over(path, now, token)
            self.files.create(path, f"{now.isoformat()} {token}")
        except Exception as error:
            raise SyncError("the replica is locked by another writer") from error
        try:
            yield
        finally:
            if self.files.exists(path) and self.files.read(path).endswith(token):
                self.files.delete(path)

    def _take_over(self, path: str, now: datetime, token: str) -> None:
        held = self.files.read(path)
        taken = _moment(held.split(" ")[0])
        if taken is None or now - taken <= LOCK_EXPIRY:
            raise SyncError("locked")
        aside = self.files.path(f"lock-{token}")
        self.files.move(path, aside)  # of several writers one succeeds
        if self.files.read(aside) != held:  # a successor's, taken since it was read
            if not self.files.exists(path):
                self.files.move(aside, path)
            raise SyncError("locked")
        self.files.delete(aside)

    def clear(self) -> None:
        """Removes all states; the lock stays."""
        for state in [n for n in self.files.names(self.files.root) if n.startswith("state-")]:
            self.files.delete(self.files.path(state))

    def _states(self) -> list[str]:
        return [n for n in self.files.names(self.files.root) if n.startswith("state-") and self.files.exists(self.files.path(n, "state", "_SUCCESS"))]

    def _part(self, name: str) -> DataFrame | None:
        states = self._states()
        return self.spark.read.parquet(self.files.path(states[-1], name)) if states else None

    def rows(self) -> DataFrame | None:
        return self._part("rows")

    def digests(self) -> DataFrame:
        found = self._part("digests")
        return self.spark.createDataFrame([], schemas.DIGESTS).select(KEY, "row_sha256") if found is None else found

    def state(self):
        found = self._part("state")
        return None if found is None else found.first()

    def apply(self, source: DataFrame, plan: DataFrame, state: tuple) -> None:
        """Writes the replica after the delta next to what it is now, verifies it, and lets it count by writing its state."""
        states = self._states()
        folder = self.files.path(f"state-{int(states[-1].removeprefix('state-')) + 1 if states else 1:09d}")
        self.files.delete(folder)
        held = self.rows()
        held = source.limit(0) if held is None else held.select(*[F.col(c) if c in held.columns else F.lit(None).cast(t).alias(c) for c, t in source.dtypes])
        diff.apply_delta(source, held, plan, [KEY]).write.parquet(f"{folder}/rows")
        new = serving.digests(source)
        diff.apply_delta(new, self.digests(), plan, [KEY]).write.parquet(f"{folder}/digests")
        stored, index = self.spark.read.parquet(f"{folder}/rows"), self.spark.read.parquet(f"{folder}/digests")
        if not diff.equal_tables(index, new, [KEY]) or not diff.equal_tables(serving.digests(stored.select(*source.columns)), new, [KEY]):
            self.files.delete(folder)
            raise SyncError("the replica isn't its source after the delta")
        self.spark.createDataFrame([state], schemas.SYNC_STATE).coalesce(1).write.parquet(f"{folder}/state")
        for old in states[:-1]:
            self.files.delete(self.files.path(old))


class Sync:
    def __init__(self, publisher: Publisher, replica: Replica, clock: Callable[[], datetime] = lambda: datetime.now(UTC)):
        self.publisher, self.replica, self.clock = publisher, replica, clock

    def _source(self):
        row = C.require_one(C.resolve_strict(self.publisher.lake.catalog.read(), features.SCHEMA_VERSION, features.FEATURE_VERSION), "to be served")
        return row, self.publisher.validate(row)

    def run(self, afresh: bool = False) -> Synced:
        """Brings the replica to its source. afresh: whatever it holds goes first, under the same lock."""
        row, source = self._source()
        digested = serving.digests(source)
        data = serving.table_digest(digested)
        with self.replica.locked(self.clock):
            if afresh:
                self.replica.clear()
            prior, index, held = self.replica.state(), self.replica.digests(), self.replica.rows()
            if prior is None and not (index.isEmpty() and (held is None or held.isEmpty())):
                raise SyncError("the replica has rows or digests, but no state")
            before = None if prior is None else (prior.schema_version, prior.feature_version)
            after = (row.schema_version, row.feature_version)
            if before is not None and not serving.may_move(before, after):
                raise SyncError("the replica's versions can't move to the source's")
            if prior is not None and index.count() != prior.row_count:
                raise SyncError("the replica's digests aren't as many as its state says")
            if held is not None and not serving.columns_change(before, after) and not diff.equal_tables(index, serving.digests(held.select(*source.columns)), [KEY]):
                raise SyncError("the replica's rows differ from its digests")
            same = prior is not None and (prior.data_sha256, prior.row_count) == (data, row.row_count) and before == after
            if same and not diff.equal_tables(digested, index, [KEY]):
                raise SyncError("the replica's digests differ from the data it was made from")
            plan = diff.delta(digested, index, [KEY], "row_sha256")
            counts = diff.delta_counts(plan).first()
            if prior is not None and not same and not counts.inserted + counts.updated + counts.deleted:
                raise SyncError("nothing differs, yet the replica's state is another")
            state = (DATASET, row.build_id, data, row.schema_version, row.feature_version, row.row_count, row.min_timestamp, row.max_timestamp, self.clock())
            self.replica.apply(source, plan, state)
        return Synced(row.build_id, counts.inserted, counts.updated, counts.deleted, counts.unchanged)

    def reconstruct(self, execute: bool = False) -> list[dict]:
        """Makes the replica anew from its source: a report of the steps in order, which ends with the first that fails. Without execute nothing is changed."""
        steps = [("source", lambda: self._source()[0].build_id), ("rebuild", lambda: vars(self.run(afresh=True))), ("verify", self.verify)]
        report: list[dict] = []
        for name, step in steps:
            if name != "source" and not execute:
                report.append({"step": name, "status": "PLANNED"})
                continue
            try:
                result = step()
            except Exception as error:
                return [*report, {"step": name, "status": "FAIL", "result": type(error).__name__}]
            status = result["status"] if name == "verify" else "PASS"
            report.append({"step": name, "status": status, "result": result})
            if status != "PASS":
                return report
        return report

    def verify(self) -> dict:
        """An independent comparison of source, digests, rows, summary and state: {"status": ..., "failed": [...], ...}."""
        try:
            row, source = self._source()
            digested, held, state = serving.digests(source), self.replica.rows(), self.replica.state()
            if held is None:
                return {"status": "FAIL", "failed": ["no replica"]}
            summary = serving.summary(held).first()
            checks = {
                "consumer": diff.equal_tables(digested, serving.digests(held.select(*source.columns)), [KEY]) if set(source.columns) <= set(held.columns) else False,
                "digest_index": diff.equal_tables(digested, self.replica.digests(), [KEY]),
                "schema": held.dtypes == source.dtypes,
                "summary": tuple(summary) == (row.row_count, row.min_timestamp, row.max_timestamp),
                "state": (state.source_build_id, state.data_sha256, state.row_count) == (row.build_id, serving.table_digest(digested), row.row_count),
            }
        except Exception as error:
            return {"status": "FAIL", "failed": [type(error).__name__]}
        failed = sorted(k for k, ok in checks.items() if not ok)
        return {"status": "FAIL" if failed else "PASS", "failed": failed, "row_count": summary.row_count}
