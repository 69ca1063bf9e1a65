"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document is a bag of sentences. A sentence's probability is logistic in the words of a vocabulary that
it holds; the document's is their noisy-or, 1 - (1 - leak) * product(1 - p_s), where `leak` stands for
documents labelled toxic without any evidence. Only documents have labels, yet training the noisy-or
finds which sentences must have caused them, and the trained scores then locate these sentences.

The model is fitted on a sample of about `training_docs` labelled documents at most, chosen by a hash of
their id, so the sample's ids can be broadcast and the documents need no shuffle; they are read once for it. Vocabulary: over the
sample, words are counted by how many documents and toxic documents hold them; those in at least
`least_docs` toxic documents whose share of toxic ones is `lift` times the overall share enter,
`most_words` at most (by likelihood ratio). Words are runs of ASCII letters
and digits and of all characters beyond ASCII, A-Z folded; sentences end at . ! ? or a new line.

Scores depend on nothing but the text. Edge cases: null and empty texts and texts without evidence score
`leak`; without labels, or without toxic ones, everything scores 0 or the leak; labels of one document
that differ count as toxic; repeated documents each get a score; documents with a null id are scored,
never learnt from and not held out; a very long text is scored whole, as one slice of its task; an empty
table has no scores and teaches nothing; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm import words as W
from tideline.llm.tables import stored, table

#: A document is toxic from this score on.
THRESHOLD = 0.3
_ENDS = W.byte_table(".!?\n")
SCORES = "id long, score double, sentences array<struct<start:int,end:int,score:double>>"


@dataclass
class Model:
    words: list[str]
    weights: np.ndarray
    bias: float
    leak: float


class _Lookup:
    """Finds a vocabulary's words in texts by their codes."""

    def __init__(self, vocabulary: list[str]):
        codes = [W.cut(data := np.frombuffer(x.encode(), np.uint8), np.array([0, len(data)]), W.NOT_ALNUM, fold=True).codes for x in vocabulary]
        codes = np.array([c[0] for c in codes], np.uint64)
        self.order = np.argsort(codes)
        self.codes = codes[self.order]
        self.filter = np.zeros(1 << 20, bool)
        self.filter[self.codes >> np.uint64(44)] = True

    def find(self, w: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """(place in the slice, index in the vocabulary) of its words."""
        if not len(self.codes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.filter[w.codes >> np.uint64(44)])
        near = np.minimum(np.searchsorted(self.codes, w.codes[at]), len(self.codes) - 1)
        same = self.codes[near] == w.codes[at]
        return at[same], self.order[near[same]]


def _evidence(data: np.ndarray, offsets: np.ndarray, lookup: _Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, sentence, word) of a slice of texts; sentences are numbered through the slice. Also the sentence of each byte."""
    w = W.cut(data, offsets, W.NOT_ALNUM, fold=True)
    at, word = lookup.find(w)
    ends = _ENDS[data]
    breaks = ends.astype(np.int64)
    edges = offsets[1:-1]
    breaks[edges[edges < len(data)] - 1] |= 1  # a text's end ends its sentence; empty texts change nothing
    sentence = np.zeros(len(data) + 1, np.int64)
    np.cumsum(breaks, out=sentence[1:])
    text = np.searchsorted(w.first, at, "right") - 1
    rows = np.unique(np.stack([text, sentence[w.starts[at]], word], 1), axis=0) if len(at) else np.zeros((0, 3), np.int64)
    return rows[:, 0], rows[:, 1], rows[:, 2], sentence


def _folded(text):
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary(labelled: DataFrame, n: int, toxic: int, *, least_docs: int = 5, lift: float = 3.0, most_words: int = 4096) -> list[str]:
    """Words that speak for toxicity, from labelled rows (text, toxic), n in all of which some are toxic."""
    if not toxic or toxic == n:
        return []
    words = F.explode(F.array_distinct(F.split(_folded(F.col("text")), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"))).alias("word")
    counts = labelled.select("toxic", words).groupBy("word").agg(F.sum("toxic").alias("k"), F.count("*").alias("m"))
    share = toxic / n
    k, m = F.col("k"), F.col("m")
    gain = k * F.log(k / (m * share)) + F.when(m > k, (m - k) * F.log((m - k) / (m * (1 - share)))).otherwise(0)
    rare = counts.where((F.col("word") != "") & (k >= least_docs) & (k > m * min(lift * share, (1 + share) / 2)))
    return sorted(r.word for r in rare.orderBy(gain.desc(), "word").limit(most_words).collect())


def training_rows(labelled: DataFrame, words: list[str]) -> DataFrame:
    """For each labelled document with evidence: toxic, and the vocabulary indices of each such sentence."""
    lookup = labelled.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Lookup(lookup.value)
        for batch in batches:
            toxic = batch.column(1).to_pylist()
            for row, data, offsets in W.slices(batch.column(0)):
                text, sentence, word, _ = _evidence(data, offsets, own)
                bags: dict[int, dict[int, list[int]]] = {}
                for t, s, x in zip(text.tolist(), sentence.tolist(), word.tolist(), strict=True):
                    bags.setdefault(t, {}).setdefault(s, []).append(x)
                yield pa.RecordBatch.from_arrays([pa.array([toxic[row + t] for t in bags], pa.int32()), pa.array([list(b.values()) for b in bags.values()], pa.list_(pa.list_(pa.int32())))], ["toxic", "bag"])

    return labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, "toxic int, bag array<array<int>>")


def fit(rows: list[tuple[int, list[list[int]]]], words: list[str], leak: float, *, penalty: float = 0.02, rounds: int = 300, rate: float = 0.15) -> Model:
    """Maximum likelihood of the noisy-or with a ridge penalty, by Adam over all rows at once."""
    bag, flat, owner, y = [], [], [], np.array([t for t, _ in rows], float)
    for d, (_, sentences) in enumerate(rows):
        for s in sentences:
            owner += [len(bag)] * len(s)
            flat += s
            bag.append(d)
    bag, flat, owner = np.array(bag, int), np.array(flat, int), np.array(owner, int)
    theta = np.r_[np.zeros(len(words)), -1.0]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1 if len(rows) else 1):
        z = theta[-1] + np.bincount(owner, theta[flat], len(bag))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        stay = np.log1p(-leak) + np.bincount(bag, np.log1p(-np.minimum(p, 1 - 1e-9)), len(rows))
        whole = np.clip(-np.expm1(stay), 1e-9, 1 - 1e-9)
        slope = p * np.where(y > 0, (1 - whole) / whole, -1.0)[bag]  # of the log likelihood by each sentence's z
        gradient = np.r_[np.bincount(flat, slope[owner], len(words)) - penalty * theta[:-1], slope.sum()]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model(words, theta[:-1], float(theta[-1]), leak)


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", training_docs: int = 30_000, **options) -> Model:
    """A model from the documents that have labels."""
    marked = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("toxic")).where("__id is not null and toxic is not null")
    share = (training_docs << 20) // max(marked.count(), 1)
    marked = marked.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < min(1 << 20, max(1, share))).groupBy("__id").agg(F.max("toxic").alias("toxic"))
    labelled = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(marked), "__id")
    labelled = stored(labelled.select("text", "toxic"), "labelled")  # read three times below
    n, toxic = labelled.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    words = vocabulary(labelled, n, toxic, **options)
    found = [(r.toxic, r.bag) for r in training_rows(labelled, words).collect()] if words else []
    unexplained, without = toxic - sum(t for t, _ in found), n - len(found)
    return fit(found, words, min(0.2, max(1e-4, unexplained / max(without, 1))) if n else 0.0)


def _scored(texts: pa.Array, model: Model, lookup: _Lookup, located: float) -> Iterator[tuple[int, np.ndarray, list[list[dict]]]]:
    """(first row, scores, places) of slices of texts."""
    for row, data, offsets in W.slices(texts):
        text, sentence, word, of_byte = _evidence(data, offsets, lookup)
        stay = np.full(len(offsets) - 1, np.log1p(-model.leak))
        places: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
        if len(text):
            sentences, first, which = np.unique(sentence, return_index=True, return_inverse=True)
            z = model.bias + np.bincount(which, model.weights[word], len(sentences))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            np.add.at(stay, text[first], np.log1p(-np.minimum(p, 1 - 1e-9)))
            for k in np.flatnonzero(p >= located).tolist():
                t = int(text[first[k]])
                a, b = int(np.searchsorted(of_byte, sentences[k])), int(np.searchsorted(of_byte, sentences[k], "right"))
                places[t].append({"start": max(a - int(offsets[t]), 0), "end": min(b, int(offsets[t + 1])) - int(offsets[t]), "score": float(p[k])})
        yield row, np.clip(-np.expm1(stay), 0.0, 1.0), places


def score(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text", located: float = 0.5) -> DataFrame:
    """id, score, and as byte ranges of the text the sentences whose own score is at least `located`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ranges = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lookup = shared.value, _Lookup(shared.value.words)
        for batch in batches:
            for row, scores, places in _scored(batch.column(1), own, lookup, located):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(scores)), pa.array(scores), pa.array(places, ranges)], ["id", "score", "sentences"])

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, SCORES)


def drop_toxic(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that score less than the threshold; nothing is shuffled."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lookup = shared.value, _Lookup(shared.value.words)
        for batch in batches:
            for row, scores, _ in _scored(batch.column(place), own, lookup, 2.0):
                yield batch.slice(row, len(scores)).filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """Rows that training never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """score() of all documents by a model trained on the labelled ones that aren't held out."""
    return score(docs, train(docs, labels.where(~held_out())))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    scored = trained_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("sentences").alias("n_sentences"))
