"""Tables of a database as a Spark source and sink, over any DB-API module that the executors have.

Reading: the table is parted at keys that stand at equal shares of its rows, whatever the key's type, and each part is
a query of its own; comparisons and null tests of columns go into the queries. Parts are read by connections of their
own, so a table that changes meanwhile may be read in two states.

Writing is in two phases. Every task inserts its rows into a stage, a table beside the target, under a token of its
own, in one transaction. The commit keeps the rows of the tokens that Spark reports, so that what a failed or repeated
task has left counts for nothing, and applies them to the target in one transaction under the database's lock; an
abort removes the stage. Rows are moved within the database by set statements.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import os
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, date, datetime

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "tideline_database"
#: Rows fetched or inserted at a time.
ROWS_AT_ONCE = 5_000
#: SQL types by Spark's names.
SQL_TYPES = {"timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE", "double": "DOUBLE PRECISION", "bigint": "BIGINT", "int": "INTEGER", "string": "TEXT", "boolean": "BOOLEAN"}
_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


class DatabaseError(RuntimeError):
    """A database isn't in the state that a write needs; the text says why."""


def quoted(name: str) -> str:
    """A name in SQL; dots part a schema and a table."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def lock_number(name: str) -> int:
    """A signed 64-bit number for a database's advisory lock."""
    return int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big", signed=True)


@dataclass(frozen=True)
class Database:
    """How to reach a database. An argument env:NAME is taken from the environment of the machine that connects."""

    driver: str
    arguments: str  #: JSON of what the module's connect takes

    @classmethod
    def of(cls, driver: str, **arguments) -> Database:
        return cls(driver, json.dumps(arguments, sort_keys=True))

    @property
    def embedded(self) -> bool:
        return self.driver == "sqlite3"

    @property
    def mark(self) -> str:
        return "?" if self.embedded else "%s"

    def connect(self):
        given = {k: os.environ[v[4:]] if isinstance(v, str) and v.startswith("env:") else v for k, v in json.loads(self.arguments).items()}
        if self.embedded:
            given = {"timeout": 60, "isolation_level": None} | given
        return importlib.import_module(self.driver).connect(**given)

    @contextmanager
    def transaction(self, lock: str | None = None) -> Iterator:
        """A cursor whose statements count together or not at all. lock: other writers under this name wait until the end."""
        connection = self.connect()
        try:
            cursor = connection.cursor()
            if self.embedded:
                cursor.execute("BEGIN IMMEDIATE" if lock else "BEGIN")
            elif lock:
                cursor.execute(f"SELECT pg_advisory_xact_lock({self.mark})", (lock_number(lock),))
            yield cursor
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def stored(self, value):
        """A value as the database takes it. An embedded one has no times: they are texts of one width, which sort like times."""
        if self.embedded and isinstance(value, datetime):
            return value.astimezone(UTC).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")
        return value.isoformat() if self.embedded and isinstance(value, date) else value

    def loaded(self, value, kind: pa.DataType):
        if isinstance(value, str) and pa.types.is_timestamp(kind):
            return datetime.fromisoformat(value)
        if isinstance(value, str) and pa.types.is_date(kind):
            return date.fromisoformat(value)
        return bool(value) if value is not None and pa.types.is_boolean(kind) else value

    def options(self) -> dict[str, str]:
        return {"driver": self.driver, "arguments": self.arguments}


def create_table(database: Database, cursor, name: str, schema: StructType, keys: Sequence[str] = (), more: Sequence[str] = ()) -> None:
    columns = [f"{quoted(f.name)} {SQL_TYPES[f.dataType.simpleString()]}{' NOT NULL' if f.name in keys else ''}" for f in schema]
    key = [f"PRIMARY KEY ({', '.join(map(quoted, keys))})"] if keys else []
    cursor.execute(f"CREATE TABLE IF NOT EXISTS {quoted(name)} ({', '.join([*columns, *more, *key])})")


def merge(database: Database, cursor, stage: str, table: str, keys: Sequence[str], columns: Sequence[str], op: str | None = "op", fixed: Sequence[tuple[str, str]] = ()) -> None:
    """A stage's inserts, updates and deletes on a table. Every update and delete must hit one row. fixed: columns that the stage lacks, with their one value."""
    same = " AND ".join(f"s.{quoted(k)} = {quoted(table)}.{quoted(k)}" for k in keys)
    only = "".join(f" AND {quoted(table)}.{quoted(c)} = {database.mark}" for c, _ in fixed)
    values = [v for _, v in fixed]
    if op:
        gone = f"FROM {quoted(stage)} s WHERE s.{quoted(op)} IN ('update', 'delete')"
        cursor.execute(f"SELECT count(*) {gone}")
        wanted = cursor.fetchone()[0]
        cursor.execute(f"DELETE FROM {quoted(table)} WHERE EXISTS (SELECT 1 {gone} AND {same}){only}", values)
        if cursor.rowcount != wanted:
            raise DatabaseError(f"{wanted} updates and deletes hit {cursor.rowcount} rows of {table}")
    names = ", ".join(map(quoted, [*(c for c, _ in fixed), *keys, *columns]))
    taken = ", ".join([*[database.mark] * len(fixed), *(f"s.{quoted(c)}" for c in [*keys, *columns])])
    cursor.execute(f"INSERT INTO {quoted(table)} ({names}) SELECT {taken} FROM {quoted(stage)} s{f' WHERE s.{quoted(op)} IN ({chr(39)}insert{chr(39)}, {chr(39)}update{chr(39)})' if op else ''}", values)


class _Part(InputPartition):
    def __init__(self, low, high, first: bool):
        self.low, self.high, self.first = low, high, first


class DatabaseReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.database, self.table, self.schema = Database(options["driver"], options["arguments"]), options["table"], schema
        self.key, self.parts = options.get("key"), int(options.get("partitions", 1))
        self.where: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            known = len(getattr(f, "attribute", ())) == 1
            column = quoted(f.attribute[0]) if known else ""
            if known and type(f) in _COMPARED and not isinstance(f.value, float):
                self.where.append((f"{column} {_COMPARED[type(f)]} {self.database.mark}", [self.database.stored(f.value)]))
            elif known and isinstance(f, In) and f.value and not any(isinstance(v, float) for v in f.value):
                self.where.append((f"{column} IN ({', '.join([self.database.mark] * len(f.value))})", list(map(self.database.stored, f.value))))
            elif known and isinstance(f, (IsNull, IsNotNull)):
                self.where.append((f"{column} IS {'NOT ' * isinstance(f, IsNotNull)}NULL", []))
            else:
                yield f

    def _query(self, columns: str, more: Sequence[tuple[str, list]] = (), after: str = "") -> tuple[str, list]:
        both = [*self.where, *more]
        return f"SELECT {columns} FROM {quoted(self.table)}{' WHERE ' * bool(both)}{' AND '.join(x for x, _ in both)}{after}", [v for _, values in both for v in values]

    def partitions(self) -> list[_Part]:
        """Ranges of the key with equal numbers of rows; rows without a key are in the first."""
        if not self.key or self.parts < 2:
            return [_Part(None, None, True)]
        key, edges = quoted(self.key), []
        with self.database.transaction() as cursor:
            present = [(f"{key} IS NOT NULL", [])]
            cursor.execute(*self._query("count(*)", present))
            n = cursor.fetchone()[0]
            for k in range(1, self.parts):
                cursor.execute(*self._query(key, present, f" ORDER BY {key} LIMIT 1 OFFSET {n * k // self.parts}"))
                if (found := cursor.fetchone()) is not None and found[0] not in edges:
                    edges.append(found[0])
        return [_Part(low, high, k == 0) for k, (low, high) in enumerate(zip([None, *edges], [*edges, None], strict=True))]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        more = []
        if partition.low is not None:
            more.append((f"{quoted(self.key)} >= {self.database.mark}", [partition.low]))
        if partition.high is not None:
            below = f"{quoted(self.key)} < {self.database.mark}"
            more.append((f"({below} OR {quoted(self.key)} IS NULL)" if partition.first else below, [partition.high]))
        arrow = to_arrow_schema(self.schema)
        with self.database.transaction() as cursor:
            cursor.execute(*self._query(", ".join(map(quoted, arrow.names)), more))
            while rows := cursor.fetchmany(ROWS_AT_ONCE):
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([self.database.loaded(v, f.type) for v in values], f.type) for values, f in zip(columns, arrow, strict=True)], schema=arrow)


@dataclass
class _Staged(WriterCommitMessage):
    token: str
    rows: int


class StageWriter(DataSourceArrowWriter):
    """Option stage: the rows are kept in a table of this name, which is the caller's to apply and to remove. Else they are applied to the option table, by the columns of the option key, as the column that the option op names says, if it is given."""

    def __init__(self, options: dict, schema: StructType):
        self.database, self.schema, self.table = Database(options["driver"], options["arguments"]), schema, options.get("table")
        self.keys, self.op = [k for k in (options.get("key") or "").split(",") if k], options.get("op")
        self.kept = options.get("stage")
        self.stage = self.kept or f"{self.table}_stage_{uuid.uuid4().hex}"
        with self.database.transaction(self.stage) as cursor:
            create_table(self.database, cursor, self.stage, schema, more=["stage_token TEXT NOT NULL"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Staged:
        staged, names = _Staged(uuid.uuid4().hex, 0), [*self.schema.fieldNames(), "stage_token"]
        insert = f"INSERT INTO {quoted(self.stage)} ({', '.join(map(quoted, names))}) VALUES ({', '.join([self.database.mark] * len(names))})"
        with self.database.transaction(self.stage) as cursor:
            for batch in iterator:
                rows = zip(*[x.to_pylist() for x in batch.columns], strict=True)
                cursor.executemany(insert, [(*map(self.database.stored, row), staged.token) for row in rows])
                staged.rows += batch.num_rows
        return staged

    def commit(self, messages: list[_Staged | None]) -> None:
        """Rows of other tokens go; then the stage is applied, unless it is the caller's."""
        staged = [m for m in messages if m is not None]
        try:
            with self.database.transaction(self.kept or self.table) as cursor:
                marks = ", ".join([self.database.mark] * len(staged))
                cursor.execute(f"DELETE FROM {quoted(self.stage)}{f' WHERE stage_token NOT IN ({marks})' if staged else ''}", [m.token for m in staged])
                cursor.execute(f"SELECT count(*) FROM {quoted(self.stage)}")
                if (found := cursor.fetchone()[0]) != (wanted := sum(m.rows for m in staged)):
                    raise DatabaseError(f"the stage holds {found} rows of {wanted}")
                if not self.kept:
                    columns = [c for c in self.schema.fieldNames() if c not in (*self.keys, self.op)]
                    merge(self.database, cursor, self.stage, self.table, self.keys, columns, self.op)
                    cursor.execute(f"DROP TABLE {quoted(self.stage)}")
        except BaseException:
            self.abort(messages)
            raise

    def abort(self, messages: list) -> None:
        with self.database.transaction(self.stage) as cursor:
            cursor.execute(f"DROP TABLE IF EXISTS {quoted(self.stage)}")


class DatabaseSource(DataSource):
    """Options: driver and arguments of Database; table; key, a column to part the table by when it is read, and the columns that name a row when it is written, joined by commas; partitions; op; stage."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        raise DatabaseError("a table of a database is read with a schema")

    def reader(self, schema: StructType) -> DatabaseReader:
        return DatabaseReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> StageWriter:
        if overwrite:
            raise DatabaseError("tables of a database are changed, not overwritten: use mode append")
        return StageWriter(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DatabaseSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def catalog_of(database: Database, schemas: Sequence[str] = ("public",)) -> dict[str, list[tuple]]:
    """Rows of a database's own catalog, of the given schemas: namespaces, classes, attributes and constraints as operators.contract takes them. They are as many as the schemas have columns."""
    with database.transaction() as cursor:
        if database.embedded:
            return _embedded_catalog(cursor)
        marks, own = ", ".join([database.mark] * len(schemas)), list(schemas)
        ask = lambda sql: (cursor.execute(sql.format(f"n.nspname IN ({marks})"), own), cursor.fetchall())[1]
        return {
            "namespaces": ask("SELECT n.oid::bigint, n.nspname::text FROM pg_namespace n WHERE {}"),
            "classes": ask("SELECT c.oid::bigint, c.relname::text, c.relnamespace::bigint FROM pg_class c JOIN pg_namespace n ON n.oid = c.relnamespace WHERE c.relkind = 'r' AND {}"),
            "attributes": ask("SELECT a.attrelid::bigint, a.attnum::int, a.attname::text, format_type(a.atttypid, a.atttypmod), NOT a.attnotnull FROM pg_attribute a JOIN pg_class c ON c.oid = a.attrelid JOIN pg_namespace n ON n.oid = c.relnamespace WHERE c.relkind = 'r' AND a.attnum > 0 AND NOT a.attisdropped AND {}"),
            "constraints": ask("SELECT k.conname::text, k.conrelid::bigint, k.contype::text, k.conkey::int[] FROM pg_constraint k JOIN pg_class c ON c.oid = k.conrelid JOIN pg_namespace n ON n.oid = c.relnamespace WHERE k.contype IN ('p', 'u') AND {}"),
        }


def _embedded_catalog(cursor) -> dict[str, list[tuple]]:
    cursor.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite_%' ORDER BY name")
    names = [r[0] for r in cursor.fetchall()]
    attributes, constraints = [], []
    for k, name in enumerate(names, 1):
        cursor.execute("SELECT cid, name, type, \"notnull\", pk FROM pragma_table_info(?) ORDER BY cid", [name])
        found = cursor.fetchall()
        attributes += [(k, cid + 1, column, kind.lower(), not required) for cid, column, kind, required, _ in found]
        if key := [cid + 1 for cid, _, _, _, pk in sorted(found, key=lambda r: r[4]) if pk]:
            constraints.append((f"{name}_key", k, "p", key))
        cursor.execute("SELECT name FROM pragma_index_list(?) WHERE origin = 'u' ORDER BY name", [name])
        for (index,) in cursor.fetchall():
            cursor.execute("SELECT cid FROM pragma_index_info(?) ORDER BY seqno", [index])
            constraints.append((index, k, "u", [r[0] + 1 for r in cursor.fetchall()]))
    return {"namespaces": [(1, "main")], "classes": [(k, name, 1) for k, name in enumerate(names, 1)], "attributes": attributes, "constraints": constraints}
