"""Benchmark decontamination with a broadcast set of benchmark n-grams.

Texts are folded (A-Z to a-z) and cut at ASCII characters that are neither letters nor digits. The
windows of the benchmark, `n` consecutive words or a shorter item as a whole, become a hash set of
64-bit codes that is broadcast; every window of every document is looked up in it, and each hit is
verified word by word before it counts. Then whole documents or just the hit spans are removed.

The set is broadcast in blocks of some `block_bytes` of benchmark text each, as arrays of some ten
times that size. One block at a time is made, broadcast, used for a scan of the documents whose hits are
stored, and destroyed, so what is held at once is bounded however large the benchmark is; what grows with
it is the number of scans. A benchmark of one block is scanned for without storing anything; of more, only
rows with hits are put together by a shuffle.

Edge cases: null or empty texts have no words and no hits; items without words and items with a null id
are ignored; very long texts are scanned whole; repeated items count once by id; repeated documents, and those with a null id, each get
their own row and are judged by their own text; an empty benchmark hits nothing; further columns of
either table are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import words as W
from tideline.llm.tables import free_name, stored, table

SCAN = "id long, n_words long, n_hit long, items array<string>, spans array<struct<first:long,last:long>>"
#: A document is contaminated if at least one of so many of its words is hit.
SHARE = 20
_FILTER_BITS = 20


class NgramSet:
    """Windows of a block of benchmark items: their codes to look up, and the words to verify with."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.items = [item for item, _ in items]
        raw = [text.encode() for _, text in items]
        self.words = w = W.cut(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), W.NOT_ALNUM, fold=True)
        sizes = np.diff(w.first)
        #: By length: sorted codes, and the first word of each.
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.filters: dict[int, np.ndarray] = {}
        for length in np.unique(np.minimum(sizes[sizes > 0], n)).tolist():
            at, codes = w.runs(length)
            own = np.isin(at, w.first[:-1][sizes == length]) if length < n else np.ones(len(at), bool)
            order = np.argsort(codes[own], kind="stable")
            self.windows[length] = codes[own][order], at[own][order]
            self.filters[length] = np.zeros(1 << _FILTER_BITS, bool)
            self.filters[length][codes[own] >> np.uint64(64 - _FILTER_BITS)] = True
        self.met: dict[tuple[int, int], dict[bytes, set[str]]] = {}

    def _of(self, length: int, code: int) -> dict[bytes, set[str]]:
        """Item ids by words of the windows with a code; put together when a document has it for the first time."""
        if (out := self.met.get((length, code))) is None:
            codes, at = self.windows[length]
            a, b = (int(np.searchsorted(codes, np.uint64(code), side)) for side in ("left", "right"))
            out = self.met[length, code] = {}
            for first, k in zip(at[a:b].tolist(), (np.searchsorted(self.words.first, at[a:b], "right") - 1).tolist(), strict=True):
                out.setdefault(self.words.joined(first, first + length), set()).add(self.items[k])
        return out

    def hits(self, w: W.Words) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, length, item ids) of each verified occurrence."""
        for length, (keys, _) in self.windows.items():
            at, codes = w.runs(length)
            likely = np.flatnonzero(self.filters[length][codes >> np.uint64(64 - _FILTER_BITS)])
            found = codes[likely]
            likely = likely[keys[np.minimum(np.searchsorted(keys, found), len(keys) - 1)] == found]
            for i in likely.tolist():
                first = int(at[i])
                if items := self._of(length, int(codes[i])).get(w.joined(first, first + length)):
                    yield first, length, items


def ngram_sets(spark: SparkSession, benchmark: DataFrame, *, n: int = 13, item_id: str = "item_id", item_text: str = "text", block_bytes: int = 16_000_000) -> tuple[int, Iterator[Broadcast]]:
    """How many blocks of items there are, at least one, and a broadcast set of the windows of each, made when it is asked for. Who asks for the next is done with the one before, which is destroyed."""
    bench = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null")
    size = bench.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1

    def made() -> Iterator[Broadcast]:
        for block in range(blocks):
            rows = bench.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
            shared = spark.sparkContext.broadcast(NgramSet([(r.item, r.text) for r in rows], n))
            yield shared
            if blocks > 1:
                shared.destroy()

    return blocks, made()


def _covered(texts: pa.Array, ngrams: NgramSet) -> Iterator[tuple[int, W.Words, np.ndarray, list[set[str]]]]:
    """(first row, words, which of them are hit, item ids of each text) of slices of texts."""
    for row, data, offsets in W.slices(texts):
        w = W.cut(data, offsets, W.NOT_ALNUM, fold=True)
        found = list(ngrams.hits(w))
        first = np.array([x[0] for x in found], np.int64)
        items: list[set[str]] = [set() for _ in range(len(offsets) - 1)]
        for text, x in zip((np.searchsorted(w.first, first, "right") - 1).tolist(), found, strict=True):
            items[text] |= x[2]
        yield row, w, W.covered_words(len(w.codes), first, np.array([x[1] for x in found], np.int64)), items


def _scan_batches(batches: Iterator[pa.RecordBatch], ngrams: NgramSet) -> Iterator[pa.RecordBatch]:
    """Rows of SCAN and text_hash of rows (id, text_hash, text)."""
    for batch in batches:
        for row, w, covered, items in _covered(batch.column(2), ngrams):
            spans = [_spans(covered[w.first[d] : w.first[d + 1]]) if found else [] for d, found in enumerate(items)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(items)), pa.array(np.diff(w.first)), pa.array(W.per_text(covered, w.first)), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), batch.column(1).slice(row, len(items))],
                ["id", "n_words", "n_hit", "items", "spans", "text_hash"],
            )


def _spans(covered: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
    return [{"first": a, "last": b - 1} for a, b in edges.reshape(-1, 2).tolist()]


def _own_key(doc_id: str, text: str) -> list[Column]:
    """What tells rows of different id or text apart."""
    return [F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash")]


def _scan(docs: DataFrame, sets: tuple[int, Iterator[Broadcast]], doc_id: str, text: str) -> DataFrame:
    """SCAN's columns and text_hash of every document."""
    rows, (blocks, shared_sets) = docs.select(*_own_key(doc_id, text), F.col(text).alias("text")), sets
    part = lambda shared: rows.mapInArrow(lambda batches: _scan_batches(batches, shared.value), f"{SCAN}, text_hash long")
    if blocks == 1:
        return part(next(shared_sets))
    parts: list[DataFrame] = []
    for shared in shared_sets:
        parts.append(stored(part(shared).where("n_hit > 0") if parts else part(shared), "benchmark-hits"))
    hits = parts[0].where("n_hit > 0")
    for part in parts[1:]:
        hits = hits.unionAll(part.where("n_hit > 0"))
    words = F.expr("flatten(transform(flatten(collect_list(spans)), s -> sequence(s.first, s.last)))")
    merged = hits.groupBy(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).agg(F.array_sort(F.array_distinct(words)).alias("hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("found"))
    first = F.filter("hit", lambda x, i: (i == 0) | (F.try_element_at("hit", i) != x - 1))
    last = F.filter("hit", lambda x, i: F.coalesce(F.try_element_at("hit", i + 2) != x + 1, F.lit(True)))
    spans = F.transform(F.arrays_zip(first.alias("first"), last.alias("last")), lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))
    merged = merged.select("hit_id", "hit_hash", F.size("hit").cast("long").alias("all_hit"), "found", spans.alias("found_spans"))
    whole = parts[0].join(merged, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left")
    return whole.select("id", "n_words", F.coalesce("all_hit", "n_hit").alias("n_hit"), F.coalesce("found", "items").alias("items"), F.coalesce("found_spans", "spans").alias("spans"), "text_hash")


def scan(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: id, n_words, n_hit, items (sorted ids as strings) and spans of hit words. options: ngram_sets()'s."""
    return _scan(docs, ngram_sets(docs.sparkSession, benchmark, **options), doc_id, text).drop("text_hash")


def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words", share: int = SHARE) -> Column:
    """True where at least one of `share` words of a document is hit."""
    return (F.col(n_hit) > 0) & (F.lit(share) * F.col(n_hit) >= F.col(n_words))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, that aren't contaminated; with one block nothing is shuffled."""
    sets = ngram_sets(docs.sparkSession, benchmark, **options)
    if sets[0] > 1:
        bad_id, bad_hash = free_name(docs, "bad_id"), free_name(docs, "bad_hash")
        bad = _scan(docs, sets, doc_id, text).where(is_contaminated()).select(F.col("id").alias(bad_id), F.col("text_hash").alias(bad_hash))
        own_id, own_hash = _own_key(doc_id, text)
        return docs.join(bad, own_id.eqNullSafe(F.col(bad_id)) & (own_hash == F.col(bad_hash)), "left_anti")
    shared, place = next(sets[1]), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, w, covered, _ in _covered(batch.column(place), shared.value):
                n_words, n_hit = np.diff(w.first), W.per_text(covered, w.first)
                yield batch.slice(row, len(n_words)).filter(pa.array((n_hit == 0) | (SHARE * n_hit < n_words)))

    return docs.mapInArrow(run, docs.schema)


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if text and spans:
                data = np.frombuffer(raw := text.encode(), np.uint8)
                w = W.cut(data, np.array([0, len(data)]), W.NOT_ALNUM, fold=True)
                edges = [0, *(x for s in spans for x in (int(w.starts[s["first"]]), int(w.ends[s["last"]]))), len(raw)]
                text = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode()
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(id, text) of all documents without the spans of words that a benchmark window covers."""
    found = _scan(docs, ngram_sets(docs.sparkSession, benchmark, **options), doc_id, text).where("n_hit > 0")
    found = found.select(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "spans").dropDuplicates(["hit_id", "hit_hash"])
    texts = docs.select(*_own_key(doc_id, text), F.col(text).alias("text"))
    rows = texts.join(found, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left")
    return rows.select("id", "text", "spans").mapInArrow(_cut_batches, "id long, text string")


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
       FROM b, unnest(range(1, greatest(len(w) - 12, least(len(w), 1)) + 1)) AS r(i)),
lengths AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS g FROM d, lengths, unnest(range(1, greatest(len(w) - m + 2, 1))) AS r(i)),
hit AS (SELECT dw.doc_id, dw.m, dw.i, bw.item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, m, i FROM hit), unnest(range(i, i + m)) AS r(p) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
