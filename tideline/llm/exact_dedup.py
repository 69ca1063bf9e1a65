"""Exact deduplication by Grace hashing: records are parted by hash until each bucket fits a table of complete contents.

Texts are equal if they are identical after lower-casing A-Z. Steps:

1. Gather: every task looks its rows up in an open-addressing table of contents. A row of known content becomes a
   member of the first copy that the task has seen; first copies go on with the number of their rows and the row
   that would stay. A full table is written out and begun anew, so a task holds `table_bytes` of text and one more
   text at most. The spill files are a Parquet table in the shared folder, which a lost executor can't take along.
2. Combine: content of which more than `fan_in` first copies are left, one from each of many tasks, is merged in
   salted groups, again and again, so that no group of copies meets in one task.
3. Part: first copies are dealt to buckets by the remainder of their hash. The records of a bucket whose distinct
   contents are over `table_bytes` are written to spill files of their own and parted again by a finer remainder,
   level by level. A bucket that holds one hash only isn't parted further: it holds one content.
4. Build: each bucket goes through an open-addressing table, which compares complete contents wherever hashes are
   equal, and gives every first copy its class. Members get the class of their first copy by a join.

Of a class the row with the largest id stays; of several rows with that id, one. Edge cases: a null text is empty,
and empty texts are a class of their own; rows without an id take part, and one of them stays only if no row of its
class has one; repeated rows are copies like others; a very long text is held whole by the task that looks it up,
and alone in its bucket if it is larger than a table; an empty table has no rows; further columns are not looked at,
and without_copies keeps them under whatever names they have. Ids are integers.
"""

from __future__ import annotations

import hashlib
import math
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import free_name, stored, table

#: Bytes of distinct content that a table holds.
TABLE_BYTES = 32_000_000
#: First copies of one content that may meet in one bucket.
FAN_IN = 64
#: Buckets that a bucket is parted into at the next level.
FAN_OUT = 16

_FOLD = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
#: First copies have a content; members have none, and links lead to the first copy that another was merged with.
_COPIES = "copy long, row long, id long, into long, rows long, code long, size long, sha binary, content binary"
_NAMES = [c.split()[0] for c in _COPIES.split(", ")]
_TYPES = {"sha": pa.binary(), "content": pa.binary()}


class ContentTable:
    """An open-addressing table with linear probing. Entries are equal if their complete contents are."""

    def __init__(self, slots: int = 1024):
        self.slots = [-1] * slots
        self.codes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def __len__(self) -> int:
        return len(self.codes)

    def find(self, code: int, content: bytes) -> tuple[int, bool]:
        """The entry of a content, and whether it was added just now."""
        slots, mask = self.slots, len(self.slots) - 1
        at = code & mask
        while (entry := slots[at]) >= 0:
            if self.codes[entry] == code and self.contents[entry] == content:
                return entry, False
            at = at + 1 & mask
        slots[at] = len(self.codes)
        self.codes.append(code)
        self.contents.append(content)
        self.bytes += len(content)
        if 3 * len(self.codes) > 2 * len(slots):
            self._grow()
        return len(self.codes) - 1, True

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, code in enumerate(self.codes):
            at = code & mask
            while self.slots[at] >= 0:
                at = at + 1 & mask
            self.slots[at] = entry


class _Classes:
    """A table of contents with what is known of each: first copy, rows, digest and the row that would stay."""

    def __init__(self):
        self.known, self.copies, self.rows, self.shas, self.best = ContentTable(), [], [], [], []

    def add(self, copy: int, code: int, sha: bytes, content: bytes, rows: int, row: int, id_: int | None) -> tuple[int, bool]:
        entry, new = self.known.find(code, content)
        rank = (id_ is not None, id_ or 0, -row)
        if new:
            self.copies.append(copy)
            self.rows.append(rows)
            self.shas.append(sha)
            self.best.append(rank)
        else:
            self.rows[entry] += rows
            self.best[entry] = max(self.best[entry], rank)
        return entry, new

    def ids(self) -> list[int | None]:
        return [id_ if named else None for named, id_, _ in self.best]

    def batch(self) -> pa.RecordBatch:
        """The first copies."""
        known = self.known
        return _batch(copy=self.copies, row=[-r for _, _, r in self.best], id=self.ids(), rows=self.rows, code=known.codes, size=[len(c) for c in known.contents], sha=self.shas, content=known.contents)


def _batch(**columns: list) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[c], _TYPES.get(c, pa.int64())) if c in columns else pa.nulls(n, _TYPES.get(c, pa.int64())) for c in _NAMES], _NAMES)


def _gather(batches: Iterator[pa.RecordBatch], table_bytes: int) -> Iterator[pa.RecordBatch]:
    """Members, and first copies whenever a table is full."""
    row = first = TaskContext.get().partitionId() << 40
    seen = _Classes()
    for batch in batches:
        copies, rows, ids = [], [], batch.column(0).cast(pa.int64()).to_pylist()
        for id_, text in zip(ids, batch.column(1).cast(pa.binary()), strict=True):
            content = (text.as_py() or b"").translate(_FOLD)
            sha = hashlib.sha256(content).digest()
            entry, _ = seen.add(first + len(seen.copies), int.from_bytes(sha[:8], "big", signed=True), sha, content, 1, row, id_)
            copies.append(seen.copies[entry])
            rows.append(row)
            row += 1
            if seen.known.bytes > table_bytes:
                yield seen.batch()
                first, seen = first + len(seen.copies), _Classes()
        yield _batch(copy=copies, row=rows, id=ids)
    yield seen.batch()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(copy, code, digest, content, rows, row, id) of first copies."""
    names = ("copy", "code", "sha", "content", "rows", "row", "id")
    for batch in batches:
        yield from zip(*[(x.as_py() for x in batch.column(batch.schema.get_field_index(n))) for n in names], strict=True)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First copies of one group merged, and a link to what is left of it for each."""
    seen, copies, into = _Classes(), [], []
    for record in _records(batches):
        entry, _ = seen.add(*record)
        copies.append(record[0])
        into.append(seen.copies[entry])
    yield seen.batch()
    yield _batch(copy=copies, into=into)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The class of every first copy of one bucket: the row that stays, its id, and the class's size and digest."""
    seen, copies, entries = _Classes(), [], []
    for record in _records(batches):
        entries.append(seen.add(*record)[0])
        copies.append(record[0])
    kept, ids = [-r for _, _, r in seen.best], seen.ids()
    pick = lambda values, kind: pa.array([values[e] for e in entries], kind)
    yield pa.RecordBatch.from_arrays([pa.array(copies, pa.int64()), pick(ids, pa.int64()), pick(kept, pa.int64()), pick(seen.rows, pa.int64()), pick(seen.shas, pa.binary())], ["copy", "keep_id", "kept_row", "group_size", "sha"])


def _combined(copies: DataFrame, fan_in: int) -> tuple[DataFrame, list[DataFrame]]:
    """First copies of which no content has over fan_in, and the links of each round to them."""
    links: list[DataFrame] = []
    while True:
        hot = stored(copies.groupBy("code").agg(F.count("*").alias("n")).where(F.col("n") > fan_in), "hot-contents")
        if not (before := hot.agg(F.sum("n")).first()[0]):
            return copies, links
        salt = F.pmod(F.xxhash64("copy"), F.ceil(F.col("n") / fan_in))
        merged = stored(copies.join(hot, "code").withColumn("salt", salt).groupBy("code", "salt").applyInArrow(_merge, _COPIES), "merged-copies")
        left = merged.where("into is null")
        if left.count() == before:
            return copies, links  # different contents of one hash: nothing to merge
        links.append(merged.where("into <> copy").select("copy", "into"))
        copies = copies.join(hot, "code", "left_anti").unionByName(left.select(copies.columns))


def _buckets(copies: DataFrame, table_bytes: int) -> DataFrame:
    """The classes of first copies, bucket by bucket and level by level."""
    spark = copies.sparkSession
    sizes = stored(copies.groupBy("code").agg(F.max("size").alias("size")), "content-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    n, done = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(2 * total / table_bytes)), []
    build = lambda rows: rows.groupBy("bucket").applyInArrow(_build, "copy long, keep_id long, kept_row long, group_size long, sha binary")
    while True:
        bucket = F.pmod(F.col("code"), F.lit(n)).alias("bucket")
        by = sizes.groupBy(bucket).agg(F.sum("size").alias("bytes"), F.count("*").alias("codes"))
        over = stored(by.where((F.col("bytes") > table_bytes) & (F.col("codes") > 1)).select("bucket"), "full-buckets")
        copies = copies.withColumn("bucket", bucket)
        if n > 1 << 56 or over.isEmpty():
            return stored(_all([*done, build(copies)]), "classes")
        done.append(build(copies.join(over, "bucket", "left_anti")))
        copies = stored(copies.join(over, "bucket", "left_semi").drop("bucket"), "spilled-bucket")
        sizes = stored(sizes.withColumn("bucket", bucket).join(over, "bucket", "left_semi").drop("bucket"), "content-sizes")
        n *= FAN_OUT


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def exact_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """For every row: doc_id, keep_id (of the row that stays), group_size, kept, and text_sha256 of the folded text."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    gathered = stored(rows.mapInArrow(lambda batches: _gather(batches, table_bytes), _COPIES), "gathered-copies")
    copies, links = _combined(gathered.where("rows is not null").drop("into"), fan_in)
    classes = _buckets(copies, table_bytes)
    for link in reversed(links):
        classes = classes.unionByName(link.join(classes.withColumnRenamed("copy", "into"), "into").select(classes.columns))
    return (
        gathered.where("rows is null")
        .select("copy", "row", "id")
        .join(classes, "copy")
        .select(F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("row") == F.col("kept_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    )


def without_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of several rows with one id and one folded text, one."""
    sha, id_ = free_name(docs, "sha"), free_name(docs, "id")
    kept = exact_duplicates(docs, doc_id=doc_id, text=text).where("kept").select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(sha))
    folded = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    marked = docs.withColumn(sha, F.sha2(folded, 256)).withColumn(id_, F.col(doc_id).cast("long"))
    return marked.join(kept, marked[id_].eqNullSafe(kept[id_]) & (marked[sha] == kept[sha]), "left_semi").dropDuplicates([id_, sha]).drop(id_, sha)


def op11_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH folded AS (SELECT doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM documents),
grouped AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM folded GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM folded JOIN grouped USING (t)
"""
