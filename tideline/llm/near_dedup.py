"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact verification.

A document's set is its distinct 5-word shingles (A-Z folded; a text of fewer words is one shingle), and
documents are linked if the Jaccard similarity of their full sets is at least 0.75; classes are the
connected components.

1. Sketch: a 128-bit code of the set, its size and 128 MinHash values. Equal sets are one node.
2. Bands of 4 values put nodes into buckets. A pair at the threshold shares no bucket with a chance of
   (1 - 0.75**4)**32, about 5 in a million, and more similar ones with less.
3. Candidates are compared in batches of 32 values. After each the posterior of the similarity under a
   uniform prior decides: a pair whose chance to reach the threshold is below `miss` is dropped. Only then
   are the texts of what survives all four batches fetched, and the pairs verified on the full sets.
4. Star round: every bucket's members against its hub, a number of pairs linear in members. The hub is the
   member whose buckets are largest in all, which in a group of near copies is what they are copies of.
   Their links give first classes.
5. Block round: buckets of three or more which still hold several classes have their remaining pairs
   compared, but those within the bucket's largest class, in blocks of `block` members (fewer if their
   sets are large); a task holds two blocks at most, whatever a bucket's size. Buckets of many blocks are parted
   by ranges of set sizes, and only blocks whose sizes can reach the threshold meet. First signatures alone are
   compared, which leaves the members that may link to another class; these are verified, and only links
   that join what hasn't yet been seen joined are emitted. A pair is looked at in the first band only that
   it shares. Small buckets share groups of about `GROUP_ROWS` rows, as many groups as that takes.
6. Links of both rounds give the components, by least labels, hooking and pointer jumping.

Edge cases: null and empty texts and texts without words have empty sets, link with nothing and are kept;
rows of one id are one document: repeated rows count once, what one of its texts links with all do, and each
row gets the size of its own set; documents with a null id form no class and are kept; a very long text's
set is made and compared whole; of hubs that tie any is taken, which changes no class; an empty table gives
no rows; columns of any other name, also of one used in here, are carried along or not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm import words as W
from tideline.llm.tables import checkpointed, free_name, stored, table

SHINGLE, PERCENT = 5, 75
BANDS, ROWS, BATCH = 32, 4, 32
VALUES = BANDS * ROWS
MISS = 1e-6
#: Members of a block, shingles of a block's sets, and rows of a group of small buckets, about.
BLOCK, BLOCK_SHINGLES, GROUP_ROWS = 512, 500_000, 1000
#: Buckets of more blocks than this are parted by ranges of set sizes; sets whose ranges are further apart than RANGES can't link.
SLICED, RANGES = 4, 2
#: After so many rounds of components the estimated sizes of their joins are forgotten.
FORGET = 6
#: Ids that may be broadcast at most; more are joined.
BROADCAST_IDS = 2_000_000
#: Buckets of so many members at most share groups.
SMALL = 64
_A = np.random.default_rng(11).integers(0, 2**64, VALUES, dtype=np.uint64) | np.uint64(1)
_B = np.random.default_rng(12).integers(0, 2**64, VALUES, dtype=np.uint64)
SKETCH = "id long, text_hash long, row long, n_shingles long, set_a long, set_b long, signature binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle codes of each text."""
    w = W.cut(data, offsets, fold=True)
    at, codes = w.runs(SHINGLE)
    sets = [np.unique(x) for x in np.split(codes, np.searchsorted(at, w.first[1:-1]))]
    n = np.diff(w.first)
    if ((n > 0) & (n < SHINGLE)).any():
        whole = w.text_codes()
        for d in np.flatnonzero((n > 0) & (n < SHINGLE)).tolist():
            sets[d] = whole[d : d + 1]
    return sets


def signature(codes: np.ndarray) -> bytes:
    best = np.full(VALUES, np.uint64(2**64 - 1))
    for k in range(0, len(codes), 1024):
        best = np.minimum(best, (codes[k : k + 1024, None] * _A + _B).min(0))
    return (best >> np.uint64(32)).astype(np.uint32).tobytes()


def least_matches(miss: float, threshold: float = PERCENT / 100) -> list[int]:
    """After each batch, the fewest matches with which a pair goes on.

    With a uniform prior and m of n values equal, the similarity's posterior is Beta(m + 1, n - m + 1), whose mass above
    t is the chance that a binomial of n + 1 trials at t gives at most m.
    """
    out = []
    for n in range(BATCH, VALUES + 1, BATCH):
        mass, m = 0.0, -1
        while mass < miss:
            m += 1
            mass += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def survivors(one: np.ndarray, others: np.ndarray, needed: list[int]) -> np.ndarray:
    """Which rows of others survive the comparison with one, batch by batch."""
    alive = np.arange(len(others))
    matches = np.zeros(len(others), np.int64)
    for k, least in enumerate(needed):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (others[alive, part] == one[part]).sum(1)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
    return alive


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two full sets reach the threshold."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), F.col(text).alias("text"))


def sketch(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """SKETCH's columns of every document; `row` numbers the rows of the stored result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for row, data, offsets in W.slices(batch.column(2)):
                sets = shingle_sets(data, offsets)
                n = len(sets)
                sums = np.array([(int(x.sum(dtype=np.uint64)), int(W.mix(x).sum(dtype=np.uint64))) for x in sets], np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), batch.column(1).slice(row, n), pa.array(np.arange(number, number + n)), pa.array([len(x) for x in sets], pa.int64()), pa.array(np.ascontiguousarray(sums[:, 0])), pa.array(np.ascontiguousarray(sums[:, 1])), pa.array([signature(x) if len(x) else None for x in sets], pa.binary())],
                    ["id", "text_hash", "row", "n_shingles", "set_a", "set_b", "signature"],
                )
                number += n

    return _texts(docs, doc_id, text).mapInArrow(run, SKETCH)


def _sets(texts: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    return [x for _, data, offsets in W.slices(texts) for x in shingle_sets(data, offsets)]


def _signatures(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, VALUES)


def _likely_pairs(batches: Iterator[pa.RecordBatch], needed: list[int]) -> Iterator[pa.RecordBatch]:
    """Rows (a, hash_a, b, hash_b, signature_a, signature_b) whose signatures survive, without these."""
    for batch in batches:
        left, right = _signatures(batch.column(4)), _signatures(batch.column(5))
        alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for k, least in enumerate(needed):
            part = slice(k * BATCH, (k + 1) * BATCH)
            matches = matches + (left[alive, part] == right[alive, part]).sum(1)
            alive, matches = alive[matches >= least], matches[matches >= least]
        yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in range(4)], ["a", "hash_a", "b", "hash_b"])


def _verify_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among rows (a, b, text_a, text_b)."""
    for whole in batches:
        for k in range(0, whole.num_rows, 64):
            batch = whole.slice(k, 64)
            pairs = zip(_sets(batch.column(2)), _sets(batch.column(3)), strict=True)
            good = pa.array([i for i, (a, b) in enumerate(pairs) if linked(a, b)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(good), batch.column(1).take(good)], ["a", "b"])


def _surviving(rows: pa.Table, needed: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(a row, rows whose signature survives against it and whose first common band it is) of pairs of different classes within and between blocks."""
    signatures, component, blocks = _signatures(rows["signature"]), rows["component"].to_numpy(), rows["block"].to_numpy()
    order: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(*(rows[c].to_pylist() for c in ("bucket", "band", "p", "q")), strict=True)):
        order.setdefault(key, []).append(i)
    for (_, band, p, q), places in order.items():
        places = np.array(places)
        left, right = places[blocks[places] == p], places[blocks[places] == q]
        for k, i in enumerate(left.tolist()):
            others = right[k + 1 :] if p == q else right
            others = others[component[others] != component[i]]
            others = others[survivors(signatures[i], signatures[others], needed)] if len(others) else others
            if len(others):
                same = (signatures[others] == signatures[i]).reshape(-1, BANDS, ROWS).all(2)
                others = others[same.argmax(1) == band]
            if len(others):
                yield i, others


PLACED = ["bucket", "band", "p", "q", "block", "id", "text_hash", "component"]


def _likely_members(rows: pa.Table, needed: list[int]) -> pa.Table:
    """The rows, but for signatures, that a signature says may link to another class."""
    likely = np.zeros(rows.num_rows, bool)
    for i, others in _surviving(rows, needed):
        likely[i] = likely[others] = True
    return rows.select(PLACED).filter(pa.array(likely))


def _verify_members(rows: pa.Table, needed: list[int]) -> pa.Table:
    """Links among rows with signatures and texts, but those between what has been seen joined."""
    texts, ids, component = rows["text"].combine_chunks(), rows["id"].to_pylist(), rows["component"].to_pylist()
    hashes = rows["text_hash"].to_pylist()
    own: dict[tuple[int, int], np.ndarray] = {}
    out: set[tuple[int, int]] = set()
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := parent.get(x, x)) != x:
            parent[x] = parent.get(y, y)
            x = y
        return x

    def full(i: int) -> np.ndarray:
        if (found := own.get((ids[i], hashes[i]))) is None:
            found = own[ids[i], hashes[i]] = _sets(texts.slice(i, 1))[0]
        return found

    for i, others in _surviving(rows, needed):
        for j in others.tolist():
            x, y = root(component[i]), root(component[j])
            if x != y and linked(full(i), full(j)):
                parent[max(x, y)] = min(x, y)
                out.add((min(ids[i], ids[j]), max(ids[i], ids[j])))
    found = sorted(out)
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def components(links: DataFrame) -> DataFrame:
    """(id, component) of the ids in links (a, b): the least id reachable.

    Each round a node takes the least of its neighbours' labels and of its label's own, and the node that a label names the
    least that any node with this label has found, so that the rounds grow as the logarithm of the longest chain.
    """
    both = checkpointed(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("component")))
    for rounds in count(1):
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "id").select("id", F.col("component").alias("before"), F.least("component", "near").alias("lower"))
        hooks = lower.where("lower < before").groupBy(F.col("before").alias("id")).agg(F.min("lower").alias("hook"))
        jump = labels.select(F.col("id").alias("lower"), F.col("component").alias("component"))
        new = lower.join(hooks, "id", "left").join(jump, "lower").select("id", "before", F.least("lower", "component", "hook").alias("component"))
        # a checkpoint keeps the size that a join is estimated at, the product of its sides', whose digits double each round
        new = checkpointed(new) if rounds % FORGET else stored(new, "labels")
        done = new.where("component <> before").isEmpty()
        labels = new.select("id", "component")
        if done:
            return labels


def _of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the wanted (id, text_hash), one row each; all texts are shuffled only where the wanted are too many to broadcast."""
    key = ["id", "text_hash"]
    wanted = stored(wanted.distinct(), "wanted")
    return texts.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, key).dropDuplicates(key)


def size_range(n):
    """The range that a set size is in. Sizes of 3 to 4 are RANGES ranges apart at most, since ranges are a little wider than they need be."""
    return F.floor(F.log(n) * (RANGES / log(100 / PERCENT * 1.0001))).cast("int")


def _star_links(members: DataFrame, signatures: DataFrame, texts: DataFrame, needed: list[int]) -> DataFrame:
    """Links between each bucket's hub and its other members."""
    weights = members.groupBy("id").agg(F.sum("members").alias("weight"))
    hubs = members.select("bucket", "band", "id").join(weights, "id").groupBy("bucket", "band").agg(F.max_by("id", "weight").alias("hub"))
    pairs = members.select("bucket", "band", "id").join(hubs, ["bucket", "band"]).where("id <> hub").select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()
    left, right = (signatures.select(F.col("id").alias(x), F.col("text_hash").alias(f"hash_{x}"), F.col("signature").alias(f"signature_{x}")) for x in "ab")
    likely = stored(pairs, "pairs").join(right, "b").join(left, "a").select("a", "hash_a", "b", "hash_b", "signature_a", "signature_b")
    likely = stored(likely.mapInArrow(lambda batches: _likely_pairs(batches, needed), "a long, hash_a long, b long, hash_b long"), "likely-pairs")
    full = stored(_of(texts, likely.select(F.col("a").alias("id"), F.col("hash_a").alias("text_hash")).unionAll(likely.select("b", "hash_b"))), "star-texts")
    left, right = (full.select(F.col("id").alias(x), F.col("text_hash").alias(f"hash_{x}"), F.col("text").alias(f"text_{x}")) for x in "ab")
    rows = likely.join(right, ["b", "hash_b"]).join(left, ["a", "hash_a"]).select("a", "b", "text_a", "text_b")
    return stored(rows.mapInArrow(_verify_pairs, "a long, b long").distinct(), "stars")


def _block_links(members: DataFrame, first: DataFrame, signatures: DataFrame, texts: DataFrame, needed: list[int], block: int) -> DataFrame:
    """Links between members of buckets that still hold several of the classes in first (id, component)."""
    key = ["bucket", "band"]
    of = members.where("members > 2").select(*key, "id", "n_shingles").join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    of = stored(of, "large-buckets")
    by_class = of.groupBy(*key, "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    largest = by_class.groupBy(*key).agg(F.count("*").alias("classes"), F.sum("n").alias("all"), F.sum("size").alias("size"), F.max(F.struct("n", "size", "component")).alias("top"))
    blocks = lambda n, size: F.ceil(F.greatest(n / block, size / BLOCK_SHINGLES)).cast("int")
    largest = largest.where("classes > 1").select(*key, "all", F.when(F.col("top.n") > 1, F.col("top.component")).alias("top"), (blocks(F.col("all"), F.col("size")) > SLICED).alias("sliced"))
    in_range = F.when(F.col("sliced"), size_range(F.col("n_shingles"))).otherwise(0)
    placed = of.join(stored(largest, "blocks"), key).withColumn("is_top", F.coalesce(F.col("component") == F.col("top"), F.lit(False))).withColumn("range", in_range)
    # a bucket's cells, of which there are two for each range of sizes at most
    cells = placed.groupBy(*key, "all", "is_top", "range").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size")).withColumn("blocks", blocks(F.col("n"), F.col("size")))
    plan = stored(cells.groupBy(*key, "all").agg(F.collect_list(F.struct("is_top", "range", "blocks")).alias("cells")), "cells")

    def number(is_top, at, k):
        """Of the largest class's blocks down from -1, of the others up from 0."""
        up = at.cast("long") * (1 << 32) + k
        return F.when(is_top, -1 - up).otherwise(up)

    placed = placed.drop("all").join(plan, key)
    own = F.filter("cells", lambda c: (c["is_top"] == F.col("is_top")) & (c["range"] == F.col("range")))[0]["blocks"]
    placed = placed.withColumn("block", number(F.col("is_top"), F.col("range"), F.pmod(F.xxhash64("id", F.lit(3)), own)))
    near = F.filter("cells", lambda c: (F.abs(c["range"] - F.col("range")) <= RANGES) & ~(c["is_top"] & F.col("is_top")))
    others = F.flatten(F.transform(near, lambda c: F.transform(F.sequence(F.lit(0), c["blocks"] - 1), lambda k: number(c["is_top"], c["range"], k))))
    dealt = placed.select(*key, "block", "id", "component", "all", F.explode(others).alias("other"))
    dealt = dealt.select(*key, F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "id", "component", "all")

    def group(groups: int):
        """Small buckets share groups, large ones have a group for each pair of blocks."""
        return F.when(F.col("all") <= SMALL, F.pmod(F.xxhash64(*key), F.lit(groups)).cast("long")).otherwise(F.xxhash64(*key, "p", "q"))

    groups = max(1, -(-(plan.where(F.col("all") <= SMALL).agg(F.sum("all")).first()[0] or 0) // GROUP_ROWS))
    compared = dealt.join(signatures, "id").withColumn("group", group(groups)).select("group", "all", *PLACED, "signature")
    columns = "bucket long, band int, p long, q long, block long, id long, text_hash long, component long"
    likely = stored(compared.select("group", *PLACED, "signature").groupBy("group").applyInArrow(lambda rows: _likely_members(rows, needed), columns), "likely-members")
    # with texts, groups are by the size of their sets too
    sized = likely.join(plan.select(*key, "all"), key).join(signatures.select("id", "text_hash", "n_shingles", "signature"), ["id", "text_hash"])
    n, size = sized.where(F.col("all") <= SMALL).agg(F.count("*"), F.sum("n_shingles")).first()
    groups = max(1, -(-n // GROUP_ROWS), -(-(size or 0) // BLOCK_SHINGLES))
    rows = sized.join(_of(texts, likely.select("id", "text_hash")), ["id", "text_hash"]).withColumn("group", group(groups)).select("group", *PLACED, "signature", "text")
    return rows.groupBy("group").applyInArrow(lambda found: _verify_members(found, needed), "a long, b long")


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """(id, text_hash, n_shingles, component_id) of every document."""
    needed = least_matches(miss)
    sketches = stored(sketch(docs, doc_id, text), "sketches")
    key = ["n_shingles", "set_a", "set_b"]
    some = sketches.where("n_shingles > 0 AND id IS NOT NULL")
    # only groups of equal sets are joined back, and as a stored table, so that a hot group's rows can be split
    equal = stored(some.groupBy(*key).agg(F.min(F.struct("id", "row")).alias("least"), F.count("*").alias("n")).where("n > 1").select(*key, F.col("least.id").alias("least_id"), F.col("least.row").alias("least_row")), "equal-sets")
    at_nodes = sketches.join(equal, key, "left").withColumn("node", F.when(F.col("n_shingles") > 0, F.coalesce("least_id", "id")))
    at_nodes = stored(at_nodes.select("id", "text_hash", "n_shingles", "node", (F.col("node").isNotNull() & (F.col("row") == F.coalesce("least_row", "row"))).alias("is_node"), "signature"), "nodes")
    nodes = at_nodes.where("is_node")
    bands = nodes.select("id", F.col("n_shingles").cast("int").alias("n_shingles"), F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(F.substring(F.col("signature"), b * (4 * ROWS) + 1, F.lit(4 * ROWS)), b))).alias("band", "bucket"))
    shared = stored(bands.groupBy("bucket", "band").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("members")).where("least < most").drop("least", "most"), "buckets")
    members = stored(bands.join(shared, ["bucket", "band"]), "members")
    signatures = stored(nodes.select("id", "text_hash", "n_shingles", "signature").join(members.select("id").distinct(), "id"), "signatures")
    texts = _texts(docs, doc_id, text).where("id is not null and text is not null")
    stars = _star_links(members, signatures, texts, needed)
    links = stars.unionAll(_block_links(members, components(stars), signatures, texts, needed, block))
    # an id whose texts are at several nodes links these
    several = at_nodes.where("id is not null and node is not null").groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("id")
    links = links.unionAll(at_nodes.select("id", "node").join(several, "id").select(F.col("id").alias("a"), F.col("node").alias("b")).where("a <> b"))
    final = components(links)
    return at_nodes.join(final.withColumnRenamed("id", "node"), "node", "left").select("id", "text_hash", "n_shingles", F.coalesce("component", "node", "id").alias("component_id"))


def near_duplicates_removed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, that have the least id of their class."""
    name = free_name(docs, "dropped")
    dropped = classes(docs, doc_id=doc_id, text=text, **options).where("component_id <> id").select(F.col("id").alias(name)).distinct()
    return docs.join(dropped, F.col(doc_id) == F.col(name), "left_anti")


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
