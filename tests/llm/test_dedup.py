import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm import near_dedup as N
from tideline.llm import substring_dedup as S

#: With further columns whose names the operators use themselves.
SCHEMA = "doc_id long, text string, id string, bucket int, text_hash string, own_id string, OWN_TEXT string, own_hash string, own_dropped string, node string, codes string, component string"
MORE = ("x", 7, *["y"] * 8)


def table(spark, docs: dict):
    return spark.createDataFrame([(d, t, *MORE) for d, t in docs.items()], SCHEMA).repartition(3)


def corpus(seed: int = 5, n: int = 90) -> dict[int, str | None]:
    """Texts with copies, near copies, shared passages, repeated words, long and empty ones."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefgh", k=r.randint(1, 6))).title()
    text = lambda k: [word() for _ in range(k)]
    passage, docs = text(70), {}
    for d in range(n):
        kind = d % 9
        base = docs.get(r.choice(list(docs))) if docs else None
        w = text(r.randint(1, 160))
        if kind == 1 and base:
            w = base.split(" ")
        elif kind == 2 and base:
            w = base.split(" ")
            for _ in range(max(1, len(w) // 25)):
                w[r.randrange(len(w))] = word()
        elif kind == 3:
            w = w[:20] + passage[r.randint(0, 20) :] + w[20:]
        elif kind == 4:
            w = [r.choice("ab")] * r.randint(1, 130)
        elif kind == 5:
            w = passage[:60] + passage[:60]
        docs[d * 3] = " ".join(w)
    docs |= {1000: None, 1001: "", 1002: " \n\t", 1003: "One", 1004: "one", 1005: "one two", 1006: " ".join(text(6000)), 1007: " ".join(passage), 1008: "\n".join(passage)}
    return docs


@pytest.fixture(scope="module")
def docs():
    return corpus()


def test_substring_dedup_is_brute_force(spark, docs):
    small = {"shard_bytes": 900, "slice_bytes": 2000}
    found = {r.id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.removals(table(spark, docs), **small).collect()}
    assert found == brute.repeats(docs)
    assert any(0 < n < w for w, n, _ in found.values())
    rows = S.without_repeats(table(spark, docs), **small)
    assert rows.dtypes == table(spark, docs).dtypes and rows.where("OWN_TEXT = 'y' and own_id = 'y' and bucket = 7").count() == len(docs)
    texts = {r.doc_id: r.text for r in rows.collect()}
    assert set(texts) == set(docs)
    for d, (_, n, sha) in found.items():
        assert texts[d] == docs[d] if n == 0 else brute.sha(texts[d]) == sha


def test_substring_dedup_needs_its_automata(monkeypatch):
    """What the automata find is all that a document can lose."""
    text, other = (" ".join(f"{c}{i}" for i in range(90)) for c in "wv")
    rows = [(0, 0, 0, 1, 5, text), (0, 0, 1, 2, 6, f"x {text}"), (0, 0, 1, 3, 7, other), (0, 1, 0, 1, 5, text), (0, 1, 1, 4, 8, text[:-8]), (1, 0, 0, 2, 5, other), (1, 0, 1, 4, 8, f"{other} {text}")]
    names = ["shard", "slice", "kind", "id", "text_hash", "text"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[a:b]]) for a, b in ((0, 2), (2, 2), (2, 5), (5, 7))]
    found = lambda: {(r["id"], x["first"], x["end"]) for batch in S._streamed(iter(b for b in batches if b.num_rows), 50) for r in batch.to_pylist() for x in r["spans"]}
    assert found() == {(2, 1, 91), (4, 0, 88), (4, 0, 90)}
    monkeypatch.setattr(S.Shard, "ends", lambda self, text: [])
    assert found() == set()


@pytest.mark.parametrize("slice_bytes", [1500, 10**9])
def test_whole_texts_alone_give_every_occurrence(spark, slice_bytes):
    """The stream step gets passages and whole texts, without codes or places, and finds all places of all passages."""
    r = random.Random(8)
    text = lambda k: [f"w{r.random()}" for _ in range(k)]
    shared = [text(k) for k in (50, 61, 120)]
    docs, want = {}, {}
    for d in range(1, 40):
        w, want[d] = text(r.randint(0, 30)), set()
        for _ in range(r.randint(0, 4)):
            k = r.randrange(3)
            want[d] |= set(range(len(w), len(w) + len(shared[k]))) if d > k else set()  # passage k is document k's
            w += shared[k] + text(r.randint(1, 70))
        docs[d] = "\n".join(w) if d % 2 else "  ".join(w)
    near = spark.createDataFrame([(d, d * 7, t, [0, 1, 2]) for d, t in docs.items()], "id long, text_hash long, text string, shards array<int>")
    passages = spark.createDataFrame([(k, k, " ".join(w)) for k, w in enumerate(shared)], "shard int, id long, words string")
    found = {x.id: {p for span in x.spans for p in range(span.first, span.end)} for x in S.located(near, passages, 50, slice_bytes).collect()}
    assert found == {d: places for d, places in want.items() if places} and len(found) > 20


def test_shard_compares_words_not_codes(monkeypatch):
    one, two = (" ".join(f"{c}{i}" for i in range(80)) for c in "ab")
    shard = S.Shard([(4, one), (6, " ".join(["a"] * 70))], 50)
    assert shard.find(5, f"x y {one} z") == [(2, 82)] and shard.find(5, two) == [] and shard.find(5, " ".join(one.split()[10:59])) == []
    assert shard.find(4, one) == shard.find(3, one) == [] and shard.find(6, "a " * 60) == []
    assert shard.find(7, "a " * 60) == [(0, 60)] and shard.find(7, "") == [] and S.Shard([], 50).find(7, one) == []
    mixed = " ".join(one.split()[:50] + two.split()[50:])
    assert shard.find(5, mixed) == [(0, 50)]
    # with codes that are all the same, the words decide
    monkeypatch.setattr(S.W, "mix", lambda x: x * np.uint64(0))
    shard = S.Shard([(4, one), (6, two)], 50)
    assert shard.find(7, f"{two} x {one}") == [(0, 80), (81, 161)] and shard.find(7, mixed) == [(0, 50)] and shard.find(5, f"{two} x {one}") == [(81, 161)]


def test_substring_dedup_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.removals(empty).collect() == [] and S.without_repeats(empty).collect() == []
    text = " ".join(f"w{i}" for i in range(60))
    twice = spark.createDataFrame([(1, text, *MORE), (1, text, *MORE), (2, text, *MORE), (None, text, *MORE)], SCHEMA)
    assert sorted((r.id or 0, r.n_removed) for r in S.removals(twice).collect()) == [(0, 0), (1, 0), (1, 0), (2, 60)]
    assert sorted((r.doc_id or 0, r.text) for r in S.without_repeats(twice).collect()) == [(0, text), (1, text), (1, text), (2, "")]


def test_substring_dedup_of_ids_with_several_texts(spark):
    text, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "wv")
    rows = [(1, text), (2, "zz " + text), (2, other + " v60"), (3, text + " q"), (3, text + " q"), (3, "r " + other), (2, text)]
    df = spark.createDataFrame([(*r, *MORE) for r in rows], SCHEMA)
    want = sorted([(1, text), (2, "zz"), (2, other + " v60"), (3, "q"), (3, "q"), (3, "r"), (2, "")])
    assert sorted((r.doc_id, r.text) for r in S.without_repeats(df).collect()) == want
    found = sorted((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in S.removals(df).collect())
    assert found == sorted((i, len(t.split()), len(t.split()) - len(k.split()), brute.sha(k)) for (i, t), k in zip(rows, [text, "zz", other + " v60", "q", "q", "r", ""], strict=True))


def test_near_dedup_is_brute_force(spark, docs):
    found = {r.id: (r.n_shingles, r.component_id) for r in N.classes(table(spark, docs)).collect()}
    assert found == brute.classes(docs)
    assert any(c != d for d, (_, c) in found.items())
    kept = {r.doc_id for r in N.near_duplicates_removed(table(spark, docs)).collect()}
    assert kept == {d for d, (_, c) in found.items() if c == d}


def test_near_dedup_in_small_blocks(spark, monkeypatch):
    """A hot group of near copies, many of which link only to some of the others."""
    r = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    docs = {}
    for d in range(150):
        w = list(base)
        for _ in range(r.choice((1, 2, 4, 6, 9))):
            w[r.randrange(len(w))] = f"x{d}_{r.random()}"
        docs[d] = " ".join(w)
    monkeypatch.setattr(N, "GROUP_ROWS", 20)
    found = {r.id: (r.n_shingles, r.component_id) for r in N.classes(table(spark, docs), block=16).collect()}
    assert found == brute.classes(docs)
    assert len({c for _, c in found.values()}) > 1


def test_size_ranges_lose_no_pair(spark):
    sizes = spark.range(1, 200_000).select(F.col("id").alias("n"), N.size_range(F.col("id")).alias("r")).orderBy("n").toPandas()
    ranges = sizes["r"].to_numpy()
    n = sizes["n"].to_numpy()
    farthest = np.minimum(100 * n // N.PERCENT, n[-1])  # the largest set that can link with one of n
    assert (np.diff(ranges) >= 0).all() and (ranges[farthest - 1] - ranges <= N.RANGES).all() and ranges[0] == 0


def test_a_hot_band_is_parted_by_size(spark, monkeypatch):
    """Sets of all sizes in one bucket: most pairs of members are never dealt to one task, and no link is lost."""
    r = random.Random(6)
    docs = {}
    for d in range(600):
        w = [f"w{k}" for k in range(int(10 * 1.4 ** r.uniform(0, 14)))]
        if d % 3:
            w[r.randrange(len(w))] = f"x{d}"
        docs[d] = " ".join(w)
    sets = {d: brute.shingles(t) for d, t in docs.items()}
    rows = spark.createDataFrame([(7, 0, d, len(s), 600) for d, s in sets.items()], "bucket long, band int, id long, n_shingles int, members long")
    sketches = N.sketch(spark.createDataFrame(list(docs.items()), "id long, text string"), "id", "text").select("id", "text_hash", "n_shingles", "signature")
    sketches = sketches.withColumn("signature", F.concat(F.unhex(F.lit("00" * 16)), F.expr("substring(signature, 17)")))  # band 0 is shared by all
    none = spark.createDataFrame([], "id long, component long")
    texts = N._texts(spark.createDataFrame(list(docs.items()), "id long, text string"), "id", "text")
    dealt, keep = [], N.stored

    def found(block):
        links = N._block_links(rows, none, sketches, texts, N.least_matches(N.MISS), block)
        return {x.id: x.component for x in N.components(links).collect()}

    def noted(df, name):
        out = keep(df, name)
        if name == "cells":
            dealt.append([c for x in out.collect() for c in x.cells])
        return out

    monkeypatch.setattr(N, "stored", noted)
    whole, parted = found(600), found(8)
    want = {d: c for d, (_, c) in brute.classes(docs).items()}
    assert whole == parted == {d: c for d, c in want.items() if d in parted} and all(c == d for d, c in want.items() if d not in parted)
    one, many = dealt
    assert [c.blocks for c in one] == [1] and len(many) > 20
    met = sum(a.blocks * b.blocks for a in many for b in many if abs(a.range - b.range) <= N.RANGES)
    assert met < 0.2 * sum(c.blocks for c in many) ** 2


def test_near_dedup_edges(spark):
    assert N.classes(spark.createDataFrame([], SCHEMA)).collect() == [] and N.near_duplicates_removed(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = spark.createDataFrame([(5, "a b c d e f", *MORE), (5, "a b c d e f", *MORE), (3, "A B C D E F", *MORE), (None, "a b c d e f", *MORE), (None, None, *MORE)], SCHEMA)
    assert sorted((r.id or 0, r.n_shingles, r.component_id or 0) for r in N.classes(rows).where("id is not null").collect()) == [(3, 2, 3), (5, 2, 3), (5, 2, 3)]
    kept = N.near_duplicates_removed(rows)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 3] and kept.dtypes == rows.dtypes


def test_near_dedup_of_ids_with_several_texts(spark):
    """Rows of an id are one document: it links with what any of its texts links with."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(80)) for c in "uvw")
    rows = [(1, one), (2, two), (5, one + " x"), (5, two + " y"), (7, three), (7, one + " x"), (8, three + " z"), (9, "alone here")]
    found = sorted((r.id, r.n_shingles, r.component_id) for r in N.classes(spark.createDataFrame([(*r, *MORE) for r in rows], SCHEMA)).collect())
    assert found == sorted((i, len(brute.shingles(t)), 9 if i == 9 else 1) for i, t in rows)


def test_posterior_bounds_prune_little_of_what_links():
    needed = N.least_matches(N.MISS)
    assert len(needed) == 4 and needed == sorted(needed) and 32 * 0.3 < needed[0] < 24 and needed[3] < 96
    rng = np.random.default_rng(0)
    one = rng.integers(0, 2**32, N.VALUES, dtype=np.uint32)
    others = np.where(rng.random((4000, N.VALUES)) < 0.75, one, one + 1).astype(np.uint32)
    assert len(N.survivors(one, others, needed)) >= 3999
    assert len(N.survivors(one, np.where(rng.random((4000, N.VALUES)) < 0.3, one, one + 1).astype(np.uint32), needed)) == 0


def test_components_take_few_rounds(spark, monkeypatch):
    """A chain of 3,000 ids in random order; with one more hop a round, and no more, it would take hundreds."""
    order, rounds = list(range(3000)), []
    random.Random(1).shuffle(order)
    for name in ("checkpointed", "stored"):
        keep = getattr(N, name)
        monkeypatch.setattr(N, name, lambda *x, keep=keep: rounds.append(1) or keep(*x))
    found = N.components(spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a long, b long"))
    assert {r.component for r in found.select("component").distinct().collect()} == {0} and len(rounds) < 22


def test_components_follow_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (101, 102)], "a long, b long")
    found = {r.id: r.component for r in N.components(links).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
