"""Hard negatives by a vector-approximation file.

Vectors become integers, floor(256 x), and scores are integer inner products. The approximation file holds, beside
each vector, the cell of each of its components: a dimension's range is cut into `CELLS` cells of equal width. For an
anchor, a table has a value for each dimension and cell: the component times the cell's middle. Looked up and summed,
they give the middle of the scores that a vector with these cells can have; half the cells' widths times the anchor's
components give how far off it can be, so that every vector gets a lower and an upper bound. All of it is integers.

1. Positives: an anchor meets the vectors of its label. A vector can be among its first `positives` only if its upper
   bound reaches the lower bound of that many others; only such vectors are scored exactly.
2. Negatives: each positive of an anchor opens a window of scores, from 0.5 to 0.95 of its own. A vector of another
   label can enter only if its bounds touch the window, and can be among the first `negatives` only if its upper
   bound reaches the lower bound of that many vectors that lie in the window for certain; only such are scored.

The file is dealt to blocks of at most `BLOCK_ROWS` vectors by a hash of its rows, within labels for the first step, so
that a label or a repeated vector isn't one group; anchors, in groups of at most `GROUP_ROWS`, are sent to every block
(all are a query set against all rows, in blocks). A block gives an anchor's few best, and these are ranked across blocks.

Edge cases: a row with a null id or label, a null vector or a component that is null or not finite takes no part; a
shorter vector counts as if ended by zeros, so an empty one scores 0 with all; ties go to the smaller id; rows that
repeat an id are rows of their own, as anchors too; an anchor without others of its label, or whose windows are empty
(all windows of positives that score below 0 are), has no rows; an empty table has none; further columns are not looked
at. Components so large that scores could leave 63 bits raise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.tables import stored, table

SCALE = 256
CELLS = 64
BLOCK_ROWS = 65_536
GROUP_ROWS = 16_384
#: A window in percent of its positive's score.
WINDOW = (50, 95)
#: Bounds that are worked on at a time.
_AT_ONCE = 2_000_000
_LEAST = np.iinfo(np.int64).min // 4


def vectors(rows: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v) of the rows that take part; v has integer components."""
    x = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(embedding).cast("array<double>").alias("x"))
    sound = F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return x.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & sound).select("vec_id", "label", F.transform("x", lambda c: F.floor(SCALE * c)).alias("v"))


def approximation_file(rows: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The stored file (row, vec_id, label, v, cells), and of each dimension the least component and the cells' width."""
    file = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    found = file.select(F.posexplode("v").alias("d", "c")).groupBy("d").agg(F.min("c").alias("low"), F.max("c").alias("high")).orderBy("d").collect()  # a row a dimension
    low, high = (np.array([min(0, r.low) for r in found], object), np.array([max(0, r.high) for r in found], object))  # 0: shorter vectors
    most = [max(-a, b) for a, b in zip(low, high, strict=True)]
    if sum(m * m for m in most) >= 1 << 60:
        raise ValueError("scores of these vectors don't fit a 64-bit integer")
    width = np.array([max(1, -(-(b - a + 1) // CELLS)) for a, b in zip(low, high, strict=True)], object)
    lows, widths = (F.array(*[F.lit(int(x)) for x in xs]).cast("array<long>") for xs in (low, width))
    cells = F.transform("v", lambda c, i: F.floor((c - F.element_at(lows, i + 1)) / F.element_at(widths, i + 1)).cast("tinyint")) if len(found) else F.array().cast("array<tinyint>")
    return stored(file.withColumn("cells", cells), "approximations"), low.astype(np.int64), width.astype(np.int64)


def _matrix(lists: pa.ChunkedArray, dims: int, kind) -> np.ndarray:
    """Rows of a list column as a matrix; missing ends are zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if (sizes == dims).all():
        return values.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), kind)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


class Block:
    """Vectors of one block with their cells, and the bounds of their scores with some anchors."""

    def __init__(self, rows: pa.Table, low: np.ndarray, width: np.ndarray):
        dims = len(low)
        self.low, self.width = low, width
        self.row, self.ids, self.labels = (rows.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.v = _matrix(rows.column("v"), dims, np.int64)
        self.cells = _matrix(rows.column("cells"), dims, np.int64)
        sizes = np.diff(rows.column("v").combine_chunks().offsets.to_numpy())
        short = np.arange(dims) >= sizes[:, None]
        self.cells[short] = np.broadcast_to((0 - low) // width, self.cells.shape)[short]

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores, anchors by rows, both doubled."""
        middles = 2 * (self.low + np.arange(CELLS)[:, None] * self.width) + self.width - 1  # doubled, by cell and dimension
        most = int((np.abs(anchors).max(initial=0) + 1) * (np.abs(middles).max(initial=0) + 1) * 2 * (len(self.low) + 1))
        kind = np.int32 if most < 1 << 31 else np.int64
        sums = np.zeros((len(self.ids), len(anchors)), kind)
        for d in range(len(self.low)):
            looked_up = np.outer(middles[:, d], anchors[:, d]).astype(kind)
            sums += looked_up[self.cells[:, d]]
        off = (np.abs(anchors) @ (self.width - 1)).astype(kind)
        return (sums - off).T, (sums + off).T

    def scores(self, anchors: np.ndarray, a: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Exact scores of the given pairs of anchor and row."""
        return np.einsum("ij,ij->i", anchors[a], self.v[r])

    def best(self, a: np.ndarray, r: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Which pairs are among the first k of their anchor."""
        order = np.lexsort((self.ids[r], -scores, a))
        rank = np.arange(len(order)) - np.searchsorted(a[order], a[order])
        return order[rank < k]


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """Of each row of values the k-th largest; the least number where there aren't so many."""
    return np.partition(values, values.shape[1] - k, axis=1)[:, -k] if values.shape[1] >= k else np.full(len(values), _LEAST)


def _chunks(anchors: int, rows: int) -> Iterator[slice]:
    step = max(1, _AT_ONCE // max(1, rows))
    return (slice(at, at + step) for at in range(0, anchors, step))


_POSITIVE = "anchor long, anchor_id long, label long, row long, vec_id long, score long"


def _positives(anchors: pa.Table, rows: pa.Table, low: np.ndarray, width: np.ndarray, k: int) -> pa.Table:
    block, q = Block(rows, low, width), _matrix(anchors.column("v"), len(low), np.int64)
    own, ids, labels = (anchors.column(c).to_numpy() for c in ("row", "vec_id", "label"))
    found: list[tuple] = []
    for part in _chunks(len(q), len(block.ids)):
        lower, upper = block.bounds(q[part])
        other = block.row != own[part, None]
        needed = _kth(np.where(other, lower.astype(np.int64), _LEAST), k)
        a, r = np.nonzero(other & (upper >= needed[:, None]))
        scores = block.scores(q[part], a, r)
        a, r, scores = (x[block.best(a, r, scores, k)] for x in (a, r, scores))
        found.append((own[part][a], ids[part][a], labels[part][a], block.row[r], block.ids[r], scores))
    return _table(_POSITIVE, found)


_NEGATIVE = "anchor long, anchor_id long, positive long, positive_id long, positive_score long, negative_id long, negative_score long"


def _negatives(anchors: pa.Table, rows: pa.Table, low: np.ndarray, width: np.ndarray, k: int) -> pa.Table:
    block, q = Block(rows, low, width), _matrix(anchors.column("v"), len(low), np.int64)
    own, ids, labels = (anchors.column(c).to_numpy() for c in ("row", "vec_id", "label"))
    each = anchors.column("windows").combine_chunks()
    windows, sizes = each.flatten(), np.diff(each.offsets.to_numpy())
    first = np.cumsum(sizes) - sizes
    positive, positive_id, positive_score = (windows.field(n).to_numpy(zero_copy_only=False) for n in ("row", "vec_id", "score"))
    found: list[tuple] = []
    for part in _chunks(len(q), len(block.ids)):
        lower, upper = block.bounds(q[part])
        differs = block.labels != labels[part, None]
        for slot in range(int(sizes[part].max(initial=0))):
            which = np.flatnonzero(sizes[part] > slot)
            w = first[part][which] + slot
            least, most = -(-WINDOW[0] * positive_score[w] // 100), WINDOW[1] * positive_score[w] // 100
            down, up = lower[which].astype(np.int64), upper[which].astype(np.int64)
            inside = differs[which] & (down >= 2 * least[:, None]) & (up <= 2 * most[:, None])
            needed = np.maximum(_kth(np.where(inside, down, _LEAST), k), 2 * least)
            a, r = np.nonzero(differs[which] & (up >= needed[:, None]) & (down <= 2 * most[:, None]))
            scores = block.scores(q[part], which[a], r)
            fits = (scores >= least[a]) & (scores <= most[a])
            a, r, scores = a[fits], r[fits], scores[fits]
            a, r, scores = (x[block.best(a, r, scores, k)] for x in (a, r, scores))
            found.append((own[part][which[a]], ids[part][which[a]], positive[w[a]], positive_id[w[a]], positive_score[w[a]], block.ids[r], scores))
    return _table(_NEGATIVE, found)


def _table(schema: str, found: list[tuple]) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * len(names)
    return pa.table([pa.array(c.astype(np.int64)) for c in columns], names)


def hard_negatives(rows: DataFrame, *, every: int = 50, positives: int = 5, negatives: int = 3) -> DataFrame:
    """For each anchor (ids divisible by `every`) and each of its first positives, the first negatives of its window.

    rows: vec_id, label and integer vectors v, as vectors() makes them.
    """
    spark = rows.sparkSession
    file, low, width = approximation_file(rows)
    is_anchor = F.col("vec_id") % every == 0
    counts = file.groupBy("label").agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("anchors")).agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("anchors").alias("anchors")).first()
    n, n_anchors = counts.n or 0, counts.anchors or 0
    block_rows = min(BLOCK_ROWS, max(256, math.ceil(n / int(spark.conf.get("spark.sql.shuffle.partitions")))))
    groups = max(1, math.ceil(n_anchors / GROUP_ROWS))
    group = F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group")

    def met(keys: list[str], blocks: int, anchors: DataFrame, columns: list[str], search, k: int, schema: str) -> DataFrame:
        """What the search finds for each group of anchors in each block of rows."""
        places = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
        left = anchors.select(*columns, group, places(blocks).alias("block"))
        block = F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks)).alias("block")
        right = file.select("row", "vec_id", "label", "v", "cells", block, places(groups).alias("group"))
        return left.groupBy(*keys, "block", "group").cogroup(right.groupBy(*keys, "block", "group")).applyInArrow(lambda a, b: search(a, b, low, width, k) if a.num_rows and b.num_rows else _table(schema, []), schema)

    anchors = stored(file.where(is_anchor).select("row", "vec_id", "label", "v"), "anchors")
    near = met(["label"], max(1, math.ceil((counts.most or 0) / block_rows)), anchors, ["row", "vec_id", "label", "v"], _positives, positives, _POSITIVE)
    ranked = near.withColumn("place", F.row_number().over(Window.partitionBy("anchor").orderBy(F.col("score").desc(), "vec_id", "row"))).where(F.col("place") <= positives)
    windows = ranked.groupBy("anchor").agg(F.collect_list(F.struct("row", "vec_id", "score")).alias("windows"))
    asking = stored(anchors.join(windows, anchors.row == windows.anchor).select("row", "vec_id", "label", "v", "windows"), "asking-anchors")
    hard = met([], max(1, math.ceil(n / block_rows)), asking, ["row", "vec_id", "label", "v", "windows"], _negatives, negatives, _NEGATIVE)
    rank = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(F.col("negative_score").desc(), "negative_id"))
    return hard.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def relabelled(rows: DataFrame) -> DataFrame:
    """The query's planted errors: every seventh id has the next label."""
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return hard_negatives(relabelled(vectors(table(spark, sf_dir, "embeddings"))))


ORACLE = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM sound a JOIN sound b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INT AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
