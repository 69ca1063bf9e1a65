"""Substring deduplication with repeated-phrase automata.

A passage is `window` (50) consecutive words; it recurs if it also starts in a document with a smaller
id, and every word of a recurring passage is removed. Four steps:

1. Sketch: each document is reduced to a digest of its word sequence and to its phrases, runs of `phrase`
   words chosen by winnowing, so that any two documents with a passage in common have a phrase in common.
   Exact copies of an earlier document go whole; only first copies go on.
2. Confirm: phrases of two documents or more lead to the windows around them: a window belongs to the
   least of its phrases, its anchor. Windows are grouped by a 64-bit code, and those of two documents are
   confirmed; the document with the least id owns them. Nothing else of the codes is kept.
3. Compile: every recurring phrase has a shard, the same for phrases near each other in the first document
   that holds them; there are as many shards as keep each at about `shard_bytes` of passages. The owners'
   confirmed windows, with their words, go to the shards of their anchors as passages, and for each shard a
   task compiles an Aho-Corasick automaton from every run of 25 words at steps of 25 (each window of 50
   holds one whole).
4. Stream: every first copy is streamed, as a whole text, through the automata of the shards that it has a
   phrase of. This loses nothing: a document with an occurrence of a passage has the phrase that is its
   anchor. Places come from the automaton alone: around the runs that it finds, windows are looked up among
   the shard's passages and compared word by word, and only what is equal is removed. A shard's documents
   are dealt to as many tasks as their bytes need, each with the shard's automaton.

Codes only narrow down what is compared: a window that is removed has been compared word by word. A window
could stay by mistake if its code is that of another confirmed one of an earlier owner, with a chance of
about one in 10**19 per pair of different windows.

Edge cases: null and empty texts have no words; texts under `window` words lose nothing; rows of one id
don't remove each other's words, whether their texts are equal or not, and each gets a row by its own text;
documents with a null id are kept whole and remove nothing; a very long text is worked on whole, once for
each shard that it has a phrase of; an empty table gives no rows; columns of any
other name, also of one used in here, are carried along or not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm import words as W
from tideline.llm.tables import free_name, stored, table

WINDOW, PHRASE = 50, 16
#: Bytes of passages in a shard and of documents that one task streams, and phrases of a document that share a shard, about.
SHARD_BYTES, SLICE_BYTES, STRETCH = 500_000, 4_000_000, 256
#: Codes that a task hands on at a time, about.
CODES = 100_000
#: Documents whose keys may be broadcast at most; more are joined.
BROADCAST_KEYS = 2_000_000
SKETCH = "id long, text_hash long, n_words long, n_bytes long, kept_sha256 string, phrases array<long>"
_NONE = hashlib.sha256(b"").hexdigest()
#: What tells rows apart.
_KEY = ["id", "text_hash"]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def joined(w: W.Words, a: int, b: int, kept: np.ndarray | None = None) -> bytes:
    """Words a to b, or the kept ones of them, joined by single spaces."""
    starts, ends = w.starts[a:b], w.ends[a:b]
    if kept is not None:
        starts, ends = starts[kept], ends[kept]
    if not len(starts):
        return b""
    if (starts[1:] == ends[:-1] + 1).all() and (w.data[ends[:-1]] == 32).all():
        return w.data[starts[0] : ends[-1]].tobytes()
    own, base = w.data[starts[0] : ends[-1]].tobytes(), int(starts[0])
    return b" ".join([own[s - base : e - base] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    bounds = pa.array(np.cumsum([0, *map(len, values)]), pa.int32())
    return pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(values) if values else np.zeros(0, np.int64), kind))


def _own_key(doc_id: str, text: str) -> list[Column]:
    """What tells rows of different id or text apart."""
    return [F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash")]


def sketch(docs: DataFrame, window: int, phrase: int, doc_id: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in W.slices(batch.column(2)):
                w = W.cut(data, offsets)
                n_texts = len(offsets) - 1
                at, codes = w.runs(phrase)
                of = np.searchsorted(w.first, at, "right") - 1
                chosen = W.winnow(codes, of, window - phrase + 1)
                phrases = [_in_order(x).view(np.int64) for x in np.split(codes[chosen], np.searchsorted(of[chosen], np.arange(1, n_texts)))]
                digests = [hashlib.sha256(joined(w, a, b)).hexdigest() for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n_texts), batch.column(1).slice(row, n_texts), pa.array(np.diff(w.first)), pa.array(np.diff(offsets)), pa.array(digests), _lists(phrases, pa.int64())],
                    ["id", "text_hash", "n_words", "n_bytes", "kept_sha256", "phrases"],
                )

    return docs.select(*_own_key(doc_id, text), F.col(text).alias("text")).mapInArrow(run, SKETCH)


def _one(text: str) -> tuple[np.ndarray, W.Words]:
    data = np.frombuffer(text.encode(), np.uint8)
    return data, W.cut(data, np.array([0, len(data)]))


def _in_order(codes: np.ndarray) -> np.ndarray:
    """Distinct codes, in the order in which they come first."""
    _, first = np.unique(codes, return_index=True)
    return codes[np.sort(first)]


def _anchored(w: W.Words, found: pa.Scalar, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, code, shard) of a text's windows whose anchor is one of the found phrases."""
    _, phrases = w.runs(phrase)
    _, windows = w.runs(window)
    if not len(windows):
        return np.zeros(0, np.int64), windows, np.zeros(0, np.int32)
    anchors = W.sliding(np.maximum(phrases, np.uint64(1)), window - phrase + 1, np.minimum)
    own = np.asarray(found.values.field("phrase"), np.int64).view(np.uint64)
    order = np.argsort(own)
    own, shards = own[order], np.asarray(found.values.field("shard"), np.int32)[order]
    near = np.minimum(np.searchsorted(own, anchors), len(own) - 1)
    places = np.flatnonzero(own[near] == anchors)
    return places, windows[places], shards[near[places]]


def _parts(w: W.Words, places: np.ndarray, shards: np.ndarray, window: int) -> list[dict]:
    """What windows cover, as runs of windows that follow each other and have one shard: shard, first word, words."""
    out = []
    for run in np.split(np.arange(len(places)), np.flatnonzero((np.diff(places) > 1) | (np.diff(shards) != 0)) + 1):
        if len(run):
            at = int(places[run[0]])
            out.append({"shard": int(shards[run[0]]), "at": at, "words": joined(w, at, int(places[run[-1]]) + window).decode()})
    return out


def window_codes(near: DataFrame, window: int, phrase: int) -> DataFrame:
    """(id, text_hash, code) of the windows of rows (id, text_hash, text, found) whose anchor was found.

    Equal windows have the same anchor, and winnowing chooses it in every document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, n = [], [], 0
            for k in range(batch.num_rows):
                _, w = _one(batch.column(2)[k].as_py())
                _, codes, _ = _anchored(w, batch.column(3)[k], window, phrase)
                found.append(np.unique(codes))
                rows.append(np.full(len(found[-1]), k))
                n += len(found[-1])
                if n >= CODES or k + 1 == batch.num_rows:
                    of = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), _signed(np.concatenate(found))], ["id", "text_hash", "code"])
                    rows, found, n = [], [], 0

    return near.select("id", "text_hash", "text", "found").mapInArrow(run, "id long, text_hash long, code long")


def owned_passages(owners: DataFrame, window: int, phrase: int) -> DataFrame:
    """Of rows (id, text, found, confirmed: codes) the passages that windows with these codes make up: (shard, id, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for k in range(batch.num_rows):
                codes = np.asarray(batch.column(3)[k].values, np.int64).view(np.uint64)
                _, w = _one(batch.column(1)[k].as_py())
                at, own, shards = _anchored(w, batch.column(2)[k], window, phrase)
                good = np.isin(own, codes)
                found += _parts(w, at[good], shards[good], window)
                ids += [batch.column(0)[k].as_py()] * (len(found) - len(ids))
            yield pa.RecordBatch.from_arrays([pa.array([x["shard"] for x in found], pa.int32()), pa.array(ids, pa.int64()), pa.array([x["words"] for x in found], pa.string())], ["shard", "id", "words"])

    return owners.select("id", "text", "found", "confirmed").mapInArrow(run, "shard int, id long, words string")


class Shard:
    """Passages of a shard, as (id of the owner, words), compiled: finds every window of them in a text."""

    def __init__(self, passages: list[tuple[int, str]], window: int):
        self.window, self.step = window, window // 2
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        data = [f" {x} ".encode() for _, x in passages]
        self.data = b"".join(data)
        self.words = w = W.cut(np.frombuffer(self.data, np.uint8), np.cumsum([0, *map(len, data)]))
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            for i in range(a, b - self.step + 1, self.step):
                self.automaton.add_word(f" {w.joined(i, i + self.step).decode()} ", self.step)
        if len(self.automaton):
            self.automaton.make_automaton()
        at, codes = w.runs(window)
        order = np.argsort(codes, kind="stable")
        #: Codes of all windows, sorted, and the first word and the owner of each.
        self.codes, self.at = codes[order], at[order]
        self.owners = np.array([owner for owner, _ in passages], np.int64)[np.searchsorted(w.first, self.at, "right") - 1] if len(at) else np.zeros(0, np.int64)

    def ends(self, text: str) -> list[int]:
        """Where in a text, whose words stand between single spaces, the runs that the automaton finds end."""
        return [end for end, _ in self.automaton.iter(text)] if len(self.automaton) else []

    def find(self, doc: int, text: str) -> list[tuple[int, int]]:
        """(first, last + 1) of the words of a document that windows owned by smaller ids cover, as ranges apart from each other."""
        _, w = _one(text)
        at, codes = w.runs(self.window)
        if not len(at):
            return []
        plain = " " + joined(w, 0, len(w.codes)).decode() + " "
        found = self.ends(plain)
        if not found:
            return []
        # the characters where words end, so that a run's last word is the one that ends before the space
        sizes = np.fromiter(map(len, plain[1:-1].split(" ")), np.int64)
        last = np.searchsorted(np.cumsum(sizes + 1), np.array(found), "left")
        near = np.zeros(len(at) + 1, np.int64)
        low = np.clip(last + 1 - self.window, 0, len(at))
        np.add.at(near, low, 1)
        np.add.at(near, np.maximum(np.minimum(last - self.step + 2, len(at)), low), -1)
        likely = np.flatnonzero(np.cumsum(near[:-1]) > 0)
        nearest = np.minimum(np.searchsorted(self.codes, codes[likely]), len(self.codes) - 1)
        known = self.codes[nearest] == codes[likely]
        likely, nearest = likely[known], nearest[known]
        if not len(likely):
            return []
        of, earlier = self.at[nearest], self.owners[nearest] < doc
        good = np.zeros(len(likely), bool)
        breaks = np.flatnonzero((np.diff(likely) != 1) | (np.diff(of) != 1)) + 1  # a run lies within one passage
        for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(likely)], strict=True):
            # one comparison for windows that follow each other in both, else each by itself
            if self._same(w, int(likely[a]), int(of[a]), b - a - 1):
                good[a:b] = earlier[a:b]
            else:
                good[a:b] = [self._is_one(w, int(i), codes[i], doc) for i in likely[a:b]]
        covered = W.covered_words(len(w.codes), likely[good], self.window)
        edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
        return [(a, b) for a, b in edges.reshape(-1, 2).tolist()]

    def _same(self, w: W.Words, i: int, j: int, more: int) -> bool:
        """Whether the windows at word i of a text and at word j of the passages, and so many more after each, have the same words."""
        n = self.window + more
        return joined(w, i, i + n) == self.data[int(self.words.starts[j]) : int(self.words.ends[j + n - 1])]

    def _is_one(self, w: W.Words, i: int, code: np.uint64, doc: int) -> bool:
        a, b = (int(np.searchsorted(self.codes, code, side)) for side in ("left", "right"))
        return any(owner < doc and self._same(w, i, j, 0) for j, owner in zip(self.at[a:b].tolist(), self.owners[a:b].tolist(), strict=True))


def _streamed(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Spans found in documents. Rows (shard, slice, kind, id, text_hash, text) are sorted: a group's passages (kind 0) stand before its documents."""
    group, passages, shard = None, [], None
    for batch in batches:
        ids, hashes, spans = [], [], []
        for key, kind, doc, text_hash, text in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), *(batch.column(c).to_pylist() for c in range(2, 6)), strict=True):
            if key != group:
                group, passages, shard = key, [], None
            if kind == 0:
                passages.append((doc, text))
                continue
            shard = shard or Shard(passages, window)
            if found := shard.find(doc, text):
                ids.append(doc)
                hashes.append(text_hash)
                spans.append([{"first": a, "end": b} for a, b in found])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))], ["id", "text_hash", "spans"])


def _among(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is one of keys, where these are few enough to be broadcast, so that a join that follows doesn't move the others; else all."""
    return df.join(F.broadcast(keys.select(*_KEY)), _KEY, "left_semi") if keys.count() <= BROADCAST_KEYS else df


def located(near: DataFrame, passages: DataFrame, window: int, slice_bytes: int) -> DataFrame:
    """(id, text_hash, spans) of the documents (id, text_hash, text, shards) in which the automata of passages (shard, id, words) find windows of earlier owners."""
    routed = near.select(*_KEY, F.explode("shards").alias("shard"), "text")
    slices = routed.join(passages.select("shard").distinct(), "shard", "left_semi").groupBy("shard")
    slices = stored(slices.agg(F.ceil(F.sum(F.octet_length("text")) / F.lit(slice_bytes)).cast("int").alias("slices")), "slices")
    each = passages.join(slices, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.lit(0).alias("kind"), "id", F.lit(0).cast("long").alias("text_hash"), F.col("words").alias("text"))
    streamed = routed.join(slices, "shard").select("shard", F.pmod(F.xxhash64(*_KEY), F.col("slices")).cast("int").alias("slice"), F.lit(1).alias("kind"), *_KEY, "text")
    rows = each.unionByName(streamed).repartition("shard", "slice").sortWithinPartitions("shard", "slice", "kind")
    spans = rows.mapInArrow(lambda batches: _streamed(batches, window), "id long, text_hash long, spans array<struct<first: long, end: long>>")
    return spans.groupBy(*_KEY).agg(F.flatten(F.collect_set("spans")).alias("spans"))


def repeated_passages(docs: DataFrame, *, window: int = WINDOW, phrase: int = PHRASE, shard_bytes: int = SHARD_BYTES, slice_bytes: int = SLICE_BYTES, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sketches with is_copy, candidate documents with their text, (id, text_hash, spans) of the words that each of them must drop)."""
    sketches = stored(sketch(docs, window, phrase, doc_id, text), "sketches")
    long = sketches.where((F.col("n_words") >= window) & F.col("id").isNotNull())
    # digests alone are joined, with a stored table so that a hot group's rows can be split; phrases stay where they are
    copied = stored(long.groupBy("kept_sha256").agg(F.min("id").alias("copy_of"), F.max("id").alias("last_id")).where("copy_of < last_id").drop("last_id"), "copied")
    copies = stored(long.select(*_KEY, "kept_sha256").join(copied, "kept_sha256").where("id > copy_of").select(*_KEY).distinct(), "copies")
    marked = sketches.drop("phrases").join(copies.withColumn("is_copy", F.lit(True)), _KEY, "left").withColumn("is_copy", F.coalesce("is_copy", F.lit(False)))
    phrases = long.select(*_KEY, "phrases").join(copies, _KEY, "left_anti").select(*_KEY, F.posexplode("phrases").alias("place", "phrase"))
    recurring = phrases.groupBy("phrase").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.min_by("place", "id").alias("place")).where("low < high")
    recurring = stored(recurring.select("phrase", "low", F.floor(F.col("place") / STRETCH).alias("stretch")), "phrases")
    n_words, n_bytes = sketches.agg(F.sum("n_words"), F.sum("n_bytes")).first()
    # a phrase stands for the words up to the next one, half a winnowing window on
    passage_bytes = recurring.count() * (window - phrase + 1) / 2 * (n_bytes or 0) / max(n_words or 0, 1)
    shards = max(1, -(-int(passage_bytes) // shard_bytes))
    found = phrases.join(recurring.select("phrase", F.pmod(F.xxhash64("low", "stretch"), F.lit(shards)).cast("int").alias("shard")), "phrase")
    found = stored(found.groupBy(*_KEY).agg(F.collect_set(F.struct("phrase", "shard")).alias("found")), "found")
    texts = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(*_own_key(doc_id, text), F.col(text).alias("text"))
    near = stored(_among(texts, found).join(found, _KEY).dropDuplicates(_KEY), "near")

    confirmed = window_codes(near, window, phrase).groupBy("code").agg(F.min(F.struct(*_KEY)).alias("low"), F.max("id").alias("high")).where("low.id < high")
    owned = stored(confirmed.groupBy("low").agg(F.collect_list("code").alias("confirmed")).select("low.*", "confirmed"), "owned")
    passages = stored(owned_passages(_among(near, owned).join(owned, _KEY), window, phrase), "passages")
    gone = located(near.withColumn("shards", F.array_distinct("found.shard")), passages, window, slice_bytes)
    return marked, near, stored(gone, "spans")


def _dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, texts, shas = [], [], []
        for k in range(batch.num_rows):
            _, w = _one(batch.column(2)[k].as_py())
            covered = np.zeros(len(w.codes), bool)
            for span in batch.column(3)[k].as_py():
                covered[span["first"] : span["end"]] = True
            kept = joined(w, 0, len(w.codes), ~covered)
            removed.append(int(covered.sum()))
            texts.append(kept.decode())
            shas.append(hashlib.sha256(kept).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())], ["id", "text_hash", "dropped", "dropped_sha256", "kept_text"])


def shortened(near: DataFrame, gone: DataFrame) -> DataFrame:
    """id, text_hash, dropped (a number of words), dropped_sha256 and kept_text of the documents that lose words."""
    rows = _among(near.select(*_KEY, "text"), gone).join(gone, _KEY)
    return rows.mapInArrow(_dropped, "id long, text_hash long, dropped long, dropped_sha256 string, kept_text string")


def removals(docs: DataFrame, **options) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every document."""
    marked, near, gone = repeated_passages(docs, **options)
    rows = marked.join(shortened(near, gone).drop("kept_text"), _KEY, "left")
    return rows.select(
        "id",
        "n_words",
        F.when(F.col("is_copy"), F.col("n_words")).otherwise(F.coalesce("dropped", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("is_copy"), F.lit(_NONE)).otherwise(F.coalesce("dropped_sha256", "kept_sha256")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with all their columns; a text that loses words becomes its other words, joined by single spaces."""
    marked, near, gone = repeated_passages(docs, doc_id=doc_id, text=text, **options)
    new_id, new_hash, new_text = (free_name(docs, x) for x in ("id", "hash", "text"))
    new = marked.where("is_copy").select("id", "text_hash", F.lit("").alias("kept_text")).distinct().unionByName(shortened(near, gone).select("id", "text_hash", "kept_text"))
    own_id, own_hash = _own_key(doc_id, text)
    merged = docs.join(new.toDF(new_id, new_hash, new_text), (own_id == F.col(new_id)) & (own_hash == F.col(new_hash)), "left")
    return merged.withColumn(text, F.coalesce(new_text, text)).drop(new_id, new_hash, new_text)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return removals(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(w[i : i + 49], ' ')) AS g FROM w, unnest(range(1, greatest(len(w) - 48, 1))) AS r(i)),
bad AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS low FROM win) WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, p FROM bad, unnest(range(i, i + 50)) AS r(p)),
per AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (SELECT w.doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM w) w
         ANTI JOIN gone ON w.doc_id = gone.doc_id AND w.p = gone.p GROUP BY w.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(per.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN per ON w.doc_id = per.doc_id LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
