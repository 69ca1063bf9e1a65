"""Stored tables: observations by month, and small tables kept as a log of commits.

Paths go through Hadoop's file system, so a lake can be a local folder or any store that Spark writes to.
"""

from __future__ import annotations

import io
import json
import os
import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline import schemas
from tideline.functions.scalars import months_of
from tideline.operators import diff

_NAME = re.compile(r"^[A-Za-z0-9][A-Za-z0-9_.=^-]*$")


class Files:
    """The few file operations that the library needs, on Spark's own file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        fs = self._path(self.root).getFileSystem(self._conf)
        self.local = fs.getUri().getScheme() == "file"
        self._fs = fs.getRawFileSystem() if self.local else fs  # without files of checksums beside others, which can't be replaced together with them

    def path(self, *parts: str) -> str:
        """A path below the root; names that could leave it raise."""
        for part in parts:
            for name in part.split("/"):
                if not _NAME.match(name) and not name.startswith("_"):
                    raise ValueError(f"not a name for a stored file: {name!r}")
        return "/".join([self.root, *parts])

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path))) if self.exists(path) else []

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} can't be moved to {target}")

    def create(self, path: str, content: str | bytes) -> None:
        """A new file; one that exists raises and stays as it is."""
        out = self._fs.create(self._path(path), False)
        try:
            out.write(bytearray(content.encode() if isinstance(content, str) else content))
        finally:
            out.close()

    def _beside(self, path: str, content: str | bytes) -> str:
        head, _, name = path.rpartition("/")
        temp = f"{head}/_{name}.{uuid.uuid4().hex}"
        self.create(temp, content)
        return temp

    def _rename(self, source: str, target: str, how: str) -> None:
        jvm, sc = self._jvm, self._jvm.org.apache.hadoop.fs
        kind = getattr(sc, "Options$Rename")
        options = jvm.java.lang.reflect.Array.newInstance(kind.valueOf(how).getClass(), 1)
        options[0] = kind.valueOf(how)
        sc.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(self._path(source), self._path(target), options)

    def write(self, path: str, content: str | bytes) -> None:
        """A file with this content, in place of one that may exist: by one rename, so that readers find the old one or the new one, as far as the file system's rename replaces at once."""
        temp = self._beside(path, content)
        if self.local:
            os.replace(self._os_path(temp), self._os_path(path))
        else:
            self._rename(temp, path, "OVERWRITE")

    def publish(self, path: str, content: str | bytes) -> bool:
        """A new file, whole from its first moment on; False, and nothing happens, if it exists already. Of several callers one succeeds."""
        temp = self._beside(path, content)
        try:
            if self.local:
                os.link(self._os_path(temp), self._os_path(path))
            else:
                self._rename(temp, path, "NONE")
            return True
        except Exception:
            if not self.exists(path):
                raise
            return False
        finally:
            self.delete(temp)

    def _os_path(self, path: str) -> str:
        return self._path(path).toUri().getPath()

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


class SmallTable:
    """A small table as a log of commits.

    A commit is a numbered file that lists the folders of rows which make up the table, each with a place; of rows with
    one key those of the later place hold. A writer reads the newest commit, writes its own rows into a new folder and
    publishes the next number, which only one of several writers can: the others read again and try the number after.
    An upsert writes its own rows only. `FAN_IN` folders of one level are merged into one of the next, so that n upserts
    write n rows some log n times in all and readers meet few folders.
    """

    FAN_IN = 16
    #: Commits that are kept. What was read from an older one can't be read again.
    KEPT = 64

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str] = ()):
        self.spark, self.files, self.schema, self.keys, self.order = spark, Files(spark, path), schema, list(keys), list(order or keys)

    def _file(self, number: int) -> str:
        return f"{self.files.root}/commit-{number:09d}"

    def _newest(self) -> tuple[int, list[dict]]:
        """The newest commit's number and folders; 0 and none where there is no commit."""
        while names := [n for n in self.files.names(self.files.root) if n.startswith("commit-")]:
            try:
                return int(names[-1].removeprefix("commit-")), json.loads(self.files.read(f"{self.files.root}/{names[-1]}"))
            except Exception:  # many commits later it is gone
                if self.files.exists(f"{self.files.root}/{names[-1]}"):
                    raise
        return 0, []

    def _rows(self, folders: list[dict]) -> DataFrame:
        """The rows that hold."""
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        read = lambda f: schemas.require_schema(self.spark.read.parquet(f"{self.files.root}/{f['folder']}"), self.schema, self.files.root)
        if len(folders) == 1:
            return read(folders[0])
        rows = None
        for f in folders:
            own = read(f).withColumn("commit_place", F.lit(f["place"]))
            rows = own if rows is None else rows.unionByName(own)
        last = F.row_number().over(Window.partitionBy(*self.keys).orderBy(F.col("commit_place").desc()))
        return rows.withColumn("commit_rank", last).where("commit_rank = 1").select(*self.schema.fieldNames())

    def read(self) -> DataFrame:
        return self._rows(self._newest()[1]).orderBy(*self.order)

    def _write(self, rows: DataFrame) -> str:
        rows = schemas.require_schema(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]), self.schema, self.files.root)
        folder = f"rows-{uuid.uuid4().hex}"
        rows.orderBy(*self.order).coalesce(1).write.parquet(f"{self.files.root}/{folder}")
        return folder

    def _commit(self, number: int, folders: list[dict]) -> bool:
        """Whether this became the commit of that number. A number that was taken and is gone doesn't count as free."""
        if not self.files.publish(self._file(number), json.dumps(folders)):
            return False
        if number > 1 and not self.files.exists(self._file(number - 1)):
            self.files.delete(self._file(number))
            return False
        return True

    def _changed(self, change: Callable[[int, list[dict]], list[dict] | None]) -> bool:
        """Commits what `change` makes of the newest commit, anew for as long as others come first; nothing if it gives None."""
        while True:
            number, folders = self._newest()
            if (after := change(number, folders)) is None:
                return False
            if self._commit(number + 1, after):
                self._sweep(number + 1)
                return True

    def _sweep(self, number: int) -> None:
        """Commits that are too old go, and the folders that only they name."""
        names = [n for n in self.files.names(self.files.root) if n.startswith("commit-")]
        old = [n for n in names if int(n.removeprefix("commit-")) <= number - self.KEPT]
        named = lambda ns: {f["folder"] for n in ns for f in json.loads(self.files.read(f"{self.files.root}/{n}"))}
        if old:
            for folder in named(old) - named([n for n in names if n not in old]):
                self.files.delete(f"{self.files.root}/{folder}")
            for n in old:
                self.files.delete(f"{self.files.root}/{n}")

    def upsert(self, rows: DataFrame) -> None:
        """Rows with new keys are added, those with known keys replaced. Of two writers' rows with one key those of the later commit hold."""
        folder = self._write(rows)
        self._changed(lambda number, folders: [*folders, {"folder": folder, "place": number + 1, "level": 0}])
        self._merge()

    def update(self, change: Callable[[DataFrame], DataFrame | None]) -> bool:
        """Replaces the table by what `change` makes of its rows, anew if another writer came first; False, and nothing happens, if it gives None."""

        written: list[str] = []

        def whole(number: int, folders: list[dict]) -> list[dict] | None:
            while written:  # for a commit that another writer's came before
                self.files.delete(f"{self.files.root}/{written.pop()}")
            if (after := change(self._rows(folders).orderBy(*self.order))) is None:
                return None
            written.append(self._write(after))
            return [{"folder": written[0], "place": number + 1, "level": 0}]

        return self._changed(whole)

    def replace(self, rows: DataFrame) -> None:
        """These rows, whatever was there before."""
        self.update(lambda before: rows)

    def _merge(self) -> None:
        """Folders of a level that has FAN_IN of them become one of the next; another writer's commit meanwhile ends the attempt, not the table."""
        number, folders = self._newest()
        for level in range(1 + max((f["level"] for f in folders), default=0)):
            own = [f for f in folders if f["level"] == level]
            if len(own) < self.FAN_IN or folders[folders.index(own[0]) : folders.index(own[-1]) + 1] != own:
                continue
            merged = {"folder": self._write(self._rows(own)), "place": own[-1]["place"], "level": level + 1}
            at = folders.index(own[0])
            folders = [*folders[:at], merged, *folders[at + len(own) :]]
            if not self._commit(number + 1, folders):
                self.files.delete(f"{self.files.root}/{merged['folder']}")
                return
            number += 1
            self._sweep(number)


class MonthlyTable:
    """Observations in folders by some columns, year and month. An update rewrites only the months that change."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, by: Sequence[str], keys: Sequence[str], kept: str | None = None):
        self.spark, self.files, self.schema = spark, Files(spark, path), schema
        self.by, self.keys, self.kept = list(by), list(keys), kept

    def read(self, **where: str) -> DataFrame:
        """All rows, or those of some folders; Spark reads no other folder."""
        if not any(n.startswith(f"{self.by[0]}=") for n in self.files.names(self.files.root)):
            return self.spark.createDataFrame([], self.schema)
        stored = StructType([*self.schema.fields]).add("year", "string").add("month", "string")
        rows = self.spark.read.schema(stored).parquet(self.files.root)
        for name, value in where.items():
            rows = rows.where(F.col(name) == value)
        return rows.select(*self.schema.fieldNames())

    def check_files(self, **where: str) -> None:
        """Compares every stored file's own columns with the schema; what differs raises with its folder.

        Spark imposes the schema on what it reads, which turns a lost column into nulls. Here each file's footer is looked at
        by the task that holds its bytes; rows aren't decoded.
        """
        below = "".join(f"/{name}={where[name]}" for name in self.by if name in where)
        if not self.files.names(self.files.root + below):
            return
        folders = [*self.by, "year", "month"]
        wanted = [(f.name, f.dataType.simpleString()) for f in self.schema if f.name not in folders]
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(self.files.root + below).where(~F.col("path").contains("/_staging/"))

        def looked_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow.parquet as pq
            from pyspark.sql.pandas.types import from_arrow_schema

            for batch in batches:
                found = [from_arrow_schema(pq.read_schema(io.BytesIO(x.as_py()))) for x in batch.column(1)]
                kinds = [[(f.name, f.dataType.simpleString()) for f in schema] for schema in found]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if k == wanted else ", ".join(f"{n} {t}" for n, t in k) for k in kinds], pa.string())], ["path", "other"])

        wrong = files.select("path", "content").mapInArrow(looked_at, "path string, other string").where("other is not null").orderBy("path").take(3)
        if wrong:
            raise TypeError("; ".join(f"{'/'.join(r.path.split('/')[-1 - len(folders) : -1])} has {r.other}" for r in wrong) + f", not {', '.join(f'{n} {t}' for n, t in wanted)}")

    def newest(self, **where: str):
        return self.read(**where).agg(F.max("observation_date")).first()[0]

    def _stage(self, rows: DataFrame, writer: str) -> DataFrame:
        path = f"{self.files.root}/_staging/{writer}/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _write(self, rows: DataFrame) -> None:
        folders = [*self.by, "year", "month"]
        rows.repartition(*folders).sortWithinPartitions(*self.keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(self.files.root)

    def upsert(self, incoming: DataFrame, then: Callable[[dict[str, int]], None] = lambda counts: None, **where: str) -> dict[str, int]:
        """Merges rows by key and returns counts of inserts, revisions, unchanged rows and written months.

        `then` is called with the counts after the months are written; if it raises, or a write does, the
        months get their old rows back. Without changes nothing is written. Rows that don't come in stay.
        """
        schemas.require_schema(incoming, self.schema, "incoming rows")
        existing = self.read(**where)
        if self.kept:
            incoming = diff.keep_when_same(existing, incoming, self.keys, self.kept, ignored=["source_url"] if "source_url" in incoming.columns else [])
        if not incoming.groupBy(*self.keys).count().where("count > 1").isEmpty():
            raise ValueError("incoming rows repeat a key")
        writer = uuid.uuid4().hex  # another writer's staged rows are left alone
        marked = self._stage(diff.classify(existing, incoming, self.keys), writer)
        counts = {r.change_type: r.n for r in marked.groupBy("change_type").agg(F.count("*").alias("n")).collect()}
        counts = {k: counts.get(v, 0) for k, v in (("inserted", "insert"), ("revised", "revision"), ("unchanged", "unchanged"))} | {"months": 0}
        try:
            if not counts["inserted"] + counts["revised"]:
                then(counts)
                return counts
            new = diff.changed(marked)
            folders = new.select(*self.by, *[x.alias(n) for x, n in zip(months_of(F.col("observation_date")), ("year", "month"), strict=True)]).distinct()
            counts["months"] = folders.count()
            year, month = months_of(F.col("observation_date"))
            before = self._stage(existing.withColumns({"year": year, "month": month}).join(F.broadcast(folders) if counts["months"] < 10_000 else folders, [*self.by, "year", "month"], "left_semi"), writer)
            kept = before.join(new.select(*self.keys), self.keys, "left_anti")
            after = self._stage(kept.unionByName(new.withColumns({"year": year, "month": month})), writer)
            try:
                self._write(after)
                then(counts)
            except BaseException:
                self._restore(before, folders)
                raise
            return counts
        finally:
            self.files.delete(f"{self.files.root}/_staging/{writer}")

    def _restore(self, before: DataFrame, folders: DataFrame) -> None:
        """Old rows back; months that had none go."""
        columns = [*self.by, "year", "month"]
        for r in folders.join(before.select(*columns).distinct(), columns, "left_anti").collect():
            self.files.delete("/".join([self.files.root, *[f"{c}={r[c]}" for c in columns]]))
        self._write(before)


class Lake:
    """The tables of one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)
        keys = ["provider", "series_id", "observation_date"]
        self.bronze = {shape: MonthlyTable(spark, self.files.path("bronze", shape), schemas.bronze(shape), ["provider", "series_id"], keys, kept="fetched_at_utc") for shape in ("ohlc", "scalar")}
        self.silver = MonthlyTable(spark, self.files.path("silver"), schemas.SILVER, ["series_id"], ["series_id", "observation_date"])
        self.state = SmallTable(spark, self.files.path("state", "ingestion"), schemas.STATE, ["provider", "series_id"])
        self.runs = SmallTable(spark, self.files.path("state", "runs"), schemas.RUNS, ["run_id"], ["started_at_utc", "run_id"])
        self.inventory = SmallTable(spark, self.files.path("state", "inventory"), schemas.INVENTORY, ["series_id"])
        self.catalog = SmallTable(spark, self.files.path("catalog"), schemas.CATALOG, ["build_id"], ["started_at_utc", "build_id"])
