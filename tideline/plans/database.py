"""A serving replica in a database: the same delta as a folder's, applied under the database's lock and verified before it counts.

Rows and digests reach a stage beside the replica's tables from many tasks and are read back and digested there. One
transaction then takes the lock, finds the state it was planned from, checks the tables' contract, applies the stage by
set statements, compares rows, digests and bounds with what they should be, and writes the state last. Whatever fails
before its end leaves the replica as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType, TimestampType

from tideline import schemas
from tideline.operators import contract, diff, features, serving
from tideline.plans.publish import DATASET
from tideline.plans.serve import KEY, SyncError
from tideline.sources import database as D

ROWS, DIGESTS, STATE, LEDGER = "features_daily", "row_digests", "sync_state", "schema_migrations"
_LEDGER = StructType([StructField("version", IntegerType()), StructField("applied_at_utc", TimestampType())])
_KEYS = {ROWS: [KEY], DIGESTS: ["dataset_id", KEY], STATE: ["dataset_id"], LEDGER: ["version"]}


def wide_schema(columns: list[str] = features.WIDE_COLUMNS) -> StructType:
    return StructType([StructField(columns[0], TimestampType()), *[StructField(c, DoubleType()) for c in columns[1:]]])


class DatabaseReplica:
    """Has what plans.serve.Replica has, so that Sync works with either. schema: of the consumers' rows."""

    def __init__(self, spark, database: D.Database, schema: StructType | None = None, parts: int = 8):
        self.spark, self.database, self.parts = spark, database, parts
        self.tables = {ROWS: schema or wide_schema(), DIGESTS: schemas.DIGESTS, STATE: schemas.SYNC_STATE, LEDGER: _LEDGER}
        self.afresh, self._planned_from = False, None
        D.register(spark)

    @property
    def lock_name(self) -> str:
        return f"tideline:{DATASET}"

    @contextmanager
    def locked(self, clock: Callable[[], datetime] = lambda: datetime.now(UTC)):
        """The lock is the database's and is taken in apply(), where the state must still be the one that was read."""
        try:
            yield
        finally:
            self.afresh = False

    def migrate(self, clock: Callable[[], datetime] = lambda: datetime.now(UTC)) -> list[str]:
        """Makes the tables, and the columns that the consumers' rows lack; what is there stays. Returns what was done; twice is once."""
        done = []
        with self.database.transaction(self.lock_name) as cursor:
            known = {name for _, name, _ in D._embedded_catalog(cursor)["classes"]} if self.database.embedded else None
            for name, schema in self.tables.items():
                if known is None or name not in known:
                    D.create_table(self.database, cursor, name, schema, _KEYS[name])
                    done.append(name)
            cursor.execute(f"SELECT * FROM {D.quoted(ROWS)} WHERE 1 = 0")
            held = {c[0] for c in cursor.description}
            for field in self.tables[ROWS]:
                if field.name not in held:
                    cursor.execute(f"ALTER TABLE {D.quoted(ROWS)} ADD COLUMN {D.quoted(field.name)} {D.SQL_TYPES[field.dataType.simpleString()]}")
                    done.append(f"{ROWS}.{field.name}")
            cursor.execute(f"SELECT count(*) FROM {D.quoted(LEDGER)} WHERE version = {self.database.mark}", [features.SCHEMA_VERSION])
            if not cursor.fetchone()[0]:
                cursor.execute(f"INSERT INTO {D.quoted(LEDGER)} VALUES ({self.database.mark}, {self.database.mark})", [features.SCHEMA_VERSION, self.database.stored(clock())])
        return done

    def violations(self, namespaces: tuple[str, ...] = ("public",)) -> DataFrame:
        """How the database's tables, columns and keys differ from what the replica needs."""
        found = D.catalog_of(self.database, namespaces)
        kinds = {"namespaces": contract.NAMESPACES, "classes": contract.CLASSES, "attributes": contract.ATTRIBUTES, "constraints": contract.CONSTRAINTS}
        frames = {name: self.spark.createDataFrame(rows, kinds[name]) for name, rows in found.items()}
        own = frames["classes"].where(~F.col("relname").contains("_stage_"))
        schema = found["namespaces"][0][1] if found["namespaces"] else namespaces[0]
        columns = [(schema, t, k, f.name, D.SQL_TYPES[f.dataType.simpleString()].lower(), f.name not in _KEYS[t]) for t, s in self.tables.items() for k, f in enumerate(s, 1)]
        keys = [(schema, t, "p", names) for t, names in _KEYS.items()]
        return contract.violations(
            self.spark.createDataFrame(columns, contract.COLUMNS),
            contract.table_columns(own, frames["namespaces"], frames["attributes"]),
            self.spark.createDataFrame(keys, contract.KEYS),
            contract.key_columns(frames["constraints"], own, frames["namespaces"], frames["attributes"]).drop("key_name"),
        )

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        """A table, in parts by its key."""
        options = self.database.options() | {"table": name, "key": KEY if KEY in (schema or self.tables[name]).fieldNames() else "", "partitions": str(self.parts)}
        return self.spark.read.format(D.FORMAT).schema(schema or self.tables[name]).options(**options).load()

    def rows(self) -> DataFrame | None:
        return None if self.afresh else self.read(ROWS)

    def digests(self) -> DataFrame:
        found = self.read(DIGESTS).where(F.col("dataset_id") == DATASET).select(KEY, "row_sha256")
        return found.limit(0) if self.afresh else found

    def state(self):
        self._planned_from = self.read(STATE).where(F.col("dataset_id") == DATASET).first()
        return None if self.afresh else self._planned_from

    def clear(self) -> None:
        """The next delta begins with an empty replica, in the same transaction."""
        self.afresh = True

    def _staged(self, rows: DataFrame, stage: str) -> DataFrame:
        rows.write.format(D.FORMAT).options(**self.database.options(), stage=stage).mode("append").save()
        return self.read(stage, rows.schema)

    def apply(self, source: DataFrame, plan: DataFrame, state: tuple) -> None:
        """Brings the replica to its source by the plan's changes, or leaves it as it is and raises."""
        if not (wrong := self.violations()).isEmpty():
            raise SyncError(f"the replica's tables break their contract: {', '.join(sorted(f'{r.violation} {r.item}' for r in wrong.take(5)))}")
        run, new = uuid.uuid4().hex, serving.digests(source)
        changes, wanted = f"changes_stage_{run}", f"wanted_stage_{run}"
        changed = plan.where("op <> 'unchanged'").select(KEY, "op").join(source, KEY, "left").join(new, KEY, "left").select("op", *source.columns, "row_sha256")
        try:
            staged = self._staged(changed, changes).where("op <> 'delete'")
            if not diff.equal_tables(serving.digests(staged.select(*source.columns)), staged.select(KEY, "row_sha256"), [KEY]):
                raise SyncError("the stage isn't what was written to it")
            self._staged(new, wanted)
            with self.database.transaction(self.lock_name) as cursor:
                self._publish(cursor, changes, wanted, [c for c in source.columns if c != KEY], state)
        except D.DatabaseError as error:
            raise SyncError(str(error)) from error
        finally:
            with self.database.transaction(changes) as cursor:
                for stage in (changes, wanted):
                    cursor.execute(f"DROP TABLE IF EXISTS {D.quoted(stage)}")

    def _count(self, cursor, sql: str, values=()) -> int:
        cursor.execute(f"SELECT count(*) FROM {sql}", list(values))
        return cursor.fetchone()[0]

    def _publish(self, cursor, changes: str, wanted: str, columns: list[str], state: tuple) -> None:
        q, mark = D.quoted, self.database.mark
        fields = schemas.SYNC_STATE.fieldNames()
        state = tuple(map(self.database.stored, state))
        known = ["source_build_id", "data_sha256", "row_count", "synced_at_utc"]
        cursor.execute(f"SELECT {', '.join(map(q, known))} FROM {q(STATE)} WHERE dataset_id = {mark}", [DATASET])
        now, before = cursor.fetchone(), self._planned_from
        planned_from = None if before is None else tuple(self.database.stored(before[c].astimezone(UTC) if isinstance(before[c], datetime) else before[c]) for c in known)
        if (None if now is None else tuple(now)) != planned_from:
            raise SyncError("another writer has changed the replica since this delta was planned")
        if self.afresh:
            cursor.execute(f"DELETE FROM {q(ROWS)}")
            cursor.execute(f"DELETE FROM {q(DIGESTS)} WHERE dataset_id = {mark}", [DATASET])
        D.merge(self.database, cursor, changes, ROWS, [KEY], columns)
        D.merge(self.database, cursor, changes, DIGESTS, [KEY], ["row_sha256"], fixed=[("dataset_id", DATASET)])

        alike = " AND ".join(f"t.{q(c)} IS NOT DISTINCT FROM s.{q(c)}" for c in columns) or "1 = 1"
        if self._count(cursor, f"{q(changes)} s LEFT JOIN {q(ROWS)} t ON t.{q(KEY)} = s.{q(KEY)} WHERE s.op <> 'delete' AND (t.{q(KEY)} IS NULL OR NOT ({alike})) OR s.op = 'delete' AND t.{q(KEY)} IS NOT NULL"):
            raise SyncError("the replica's rows aren't those of the delta after it was applied")
        index, source = f"SELECT {q(KEY)}, row_sha256 FROM {q(DIGESTS)} WHERE dataset_id = {mark}", f"SELECT {q(KEY)}, row_sha256 FROM {q(wanted)}"
        if self._count(cursor, f"({index} EXCEPT {source}) x", [DATASET]) or self._count(cursor, f"({source} EXCEPT {index}) x", [DATASET]):
            raise SyncError("the replica's digests aren't its source's after the delta")
        if self._count(cursor, f"{q(ROWS)} t LEFT JOIN {q(wanted)} w ON w.{q(KEY)} = t.{q(KEY)} WHERE w.{q(KEY)} IS NULL"):
            raise SyncError("the replica holds rows that its source lacks")
        cursor.execute(f"SELECT count(*), min({q(KEY)}), max({q(KEY)}) FROM {q(ROWS)}")
        if tuple(cursor.fetchone()) != tuple(state[fields.index(c)] for c in ("row_count", "min_timestamp", "max_timestamp")):
            raise SyncError("the replica's bounds aren't its state's after the delta")
        cursor.execute(f"DELETE FROM {q(STATE)} WHERE dataset_id = {mark}", [DATASET])
        cursor.execute(f"INSERT INTO {q(STATE)} ({', '.join(map(q, fields))}) VALUES ({', '.join([mark] * len(fields))})", state)
