import itertools
import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from helpers import SF

from tideline.llm import exact_dedup as E
from tideline.llm import hard_negatives as H
from tideline.llm import tokenizer_alignment as A
from tideline.llm.bpe import public_path
from tideline.llm.queries import QUERIES

# --- exact duplicates --------------------------------------------------------------------------------

#: With further columns whose names the operators use themselves.
DOCS = "doc_id long, text string, id string, copy int, OWN_SHA string, own_id string, rows string, bucket int"


def table(spark, rows, parts: int = 3):
    return spark.createDataFrame([(d, t, "x", 1, "y", "z", "r", 2) for d, t in rows], DOCS).repartition(parts)


def copies(rows):
    """What exact_duplicates must give for rows with different ids."""
    groups: dict[str, list] = {}
    for d, t in rows:
        groups.setdefault(brute.fold(t), []).append(d)
    return sorted((d, max(groups[brute.fold(t)]), len(groups[brute.fold(t)]), d == max(groups[brute.fold(t)]), brute.sha(brute.fold(t))) for d, t in rows)


def corpus():
    r = random.Random(3)
    texts = [None, "", "A", "a", "É", "é", "a ", "long " * 4000, "LONG " * 4000, "long " * 4000 + "x"] + ["".join(r.choices("abcAB ", k=r.randint(1, 5))) for _ in range(200)]
    return [(d, r.choice(texts)) for d in range(600)]


@pytest.mark.parametrize(("table_bytes", "fan_in"), [(E.TABLE_BYTES, E.FAN_IN), (300, 2), (1, 1)])
def test_copies_are_found_however_small_tables_are(spark, table_bytes, fan_in):
    rows = corpus()
    found = E.exact_duplicates(table(spark, rows, 7), table_bytes=table_bytes, fan_in=fan_in)
    assert sorted(map(tuple, found.collect())) == copies(rows)


def test_contents_of_one_hash_stay_apart():
    known = E.ContentTable(4)
    contents = [str(i).encode() for i in range(50)]
    assert [known.find(7, c) for c in contents] == [(i, True) for i in range(50)]
    assert [known.find(7, c) for c in contents] == [(i, False) for i in range(50)]
    assert known.find(7 + len(known.slots), contents[0]) == (50, True)  # the same content under another hash is looked for elsewhere
    batch = E._batch(copy=[1, 2, 3], row=[1, 2, 3], id=[10, 20, 30], rows=[1, 1, 2], code=[5, 5, 5], size=[1, 1, 1], sha=[b"s"] * 3, content=[b"p", b"q", b"p"])
    assert [x.to_pylist() for x in E._build(iter([batch]))] == [[{"copy": 1, "keep_id": 30, "kept_row": 3, "group_size": 3, "sha": b"s"}, {"copy": 2, "keep_id": 20, "kept_row": 2, "group_size": 1, "sha": b"s"}, {"copy": 3, "keep_id": 30, "kept_row": 3, "group_size": 3, "sha": b"s"}]]


def test_one_row_of_a_class_stays_whatever_its_ids(spark):
    found = E.exact_duplicates(table(spark, [(None, "a"), (None, "A"), (None, "b"), (4, "B"), (9, "c"), (9, "C"), (9, "c")])).collect()
    assert sorted((r.keep_id or -1, r.group_size, r.kept) for r in found) == [(-1, 2, False), (-1, 2, True), (4, 2, False), (4, 2, True), (9, 3, False), (9, 3, False), (9, 3, True)]
    rows = [(None, "a"), (1, None), (2, ""), (3, "x"), (3, "X"), (3, "y"), (5, "Y")]
    assert E.without_copies(table(spark, rows)).columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted((r.doc_id or -1, (r.text or "").lower()) for r in E.without_copies(table(spark, rows)).collect()) == [(-1, "a"), (2, ""), (3, "x"), (5, "y")]
    assert E.exact_duplicates(table(spark, [])).count() == E.without_copies(table(spark, [])).count() == 0


# --- alignment ---------------------------------------------------------------------------------------

HARD = [
    "plain words, and some more.", "", None, " ", "  ", "a ", " a", "a  ", "  a  b   c", "tab\t end\n  new line\n", "a\n b", "x▁y", "▁", "nbsp  x  y", "  em  ", "日本語 テスト　全角", "é é ́x",
    "😀😀 🏳️‍🌈 z", "<|endoftext|> <s> </s> <unk> <0x41>", "\x00 \x01", "\x1c y \x1c", "a" * 3000, "don't we'll I'M it's", "1234567890 12 345", "x" + " " * 200 + "y", "-" * 100 + " " + "=" * 99, "ﬁ ① ½", "naïve façade  Straße", "a b\r\n c d   e",
]


def plainly(own, text):
    """The groups of one text; None if tokens don't give back its bytes."""
    ids = [e.tolist() if hasattr(e, "tolist") else e for e in own.encode(text)]
    tokens = [[own.a_bytes[i] for i in ids[0]], [own.b_bytes[i] for i in ids[1]]]
    if any(b"".join(x) != b" " + text.encode() for x in tokens):
        return None
    ends = [list(itertools.accumulate(map(len, x))) for x in tokens]
    out, edges = [], sorted(set(ends[0]) & set(ends[1]))
    for low, high in zip([0, *edges], edges):
        out.append(tuple([i for i, e in zip(ids[k], ends[k]) if low < e <= high] for k in (0, 1)))
    return out


def aligned(texts):
    """What align() must give, by whole texts."""
    own, rows, counts = A.Aligner(public_path(), public_path("piece_bpe_32k.model")), [], Counter()
    for t in texts:
        groups = plainly(own, t) if t else None
        links = Counter((x, y) for p, q in groups or () for x in p for y in q)
        counts.update(links.keys())
        rows.append((groups, links))
    best: dict[int, int] = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for groups, links in rows:
        n = lambda k: sum(len(g[k]) for g in groups or ())  # noqa: B023, E731
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups or ())
        out.append((n(0), n(1), len(groups or ()), sum(links.values()), sum(m for p, m in links.items() if counts[p] == best[p[0]]), sum(m * counts[p] for p, m in links.items()), brute.sha(text) if groups else ""))
    return out


@pytest.mark.parametrize("block_bytes", [A.BLOCK_BYTES, 50])
def test_alignment_is_that_of_whole_texts(spark, block_bytes):
    texts = HARD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    found = A.align(table(spark, list(enumerate(texts))), block_bytes=block_bytes).collect()
    assert [tuple(r)[1:] for r in sorted(found)] == aligned(texts)
    assert A.align(table(spark, [])).count() == 0
    assert [tuple(r) for r in A.align(table(spark, [(None, None), (1, "")])).orderBy("doc_id").collect()] == [(None, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_without_cuts_is_the_same(spark, monkeypatch):
    rows = table(spark, list(enumerate(HARD)))
    want = sorted(map(tuple, A.align(rows).collect()))
    monkeypatch.setattr(A, "cuts_hold", lambda a, b: False)
    assert sorted(map(tuple, A.align(rows).collect())) == want


def test_cuts_are_verified(tmp_path):
    import json

    a, b = public_path(), public_path("piece_bpe_32k.model")
    assert A.cuts_hold(a, b)
    with open(a, encoding="utf-8") as file:
        spec = json.load(file)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "use_regex": False}}, {"model": {**spec["model"], "vocab": {**spec["model"]["vocab"], "xĠy": 99_999}}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(spec | change), encoding="utf-8")
        assert not A.cuts_hold(str(path), b)


def test_segments_end_before_runs_that_begin_with_a_space():
    assert A.segments("a b") == ["a", "b"] and A.segments(" a") == [" a"] and A.segments("a ") == ["a "] and A.segments("a  b c") == ["a", " b", "c"]
    assert A.segments("a\n b \nc") == ["a\n b", "\nc"]
    for t in filter(None, HARD):
        assert "".join(" " + x for x in A.segments(t)) == " " + t and (len(t) < 2 or "" not in A.segments(t))


# --- hard negatives ----------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, row string, block int, V string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(map(lambda x: None if x is None else float(x), v)), k, "r", 1, "v") for i, v, k in rows], VECTORS).repartition(3)


def mined(rows):
    """By all scores; ids don't repeat."""
    sound = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], k) for i, v, k in rows if None not in (i, v, k) and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    score = lambda v, w: sum(a * b for a, b in zip(v, w))
    out = []
    for i, v, k in sound:
        if i % 50:
            continue
        others = sorted((-score(v, w), j, m) for j, w, m in sound if j != i)
        for p, j, m in [x for x in others if x[2] == k][:5]:
            fitting = [(n, o) for n, o, m in others if m != k and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(i, j, rank, o, -p, -n) for rank, (n, o) in enumerate(fitting[:3], 1)]
    return sorted(out)


@pytest.mark.parametrize(("block", "group", "cells"), [(H.BLOCK_ROWS, H.GROUP_ROWS, 64), (40, 2, 64), (40, 2, 2)])
def test_negatives_are_those_of_all_scores(spark, monkeypatch, block, group, cells):
    r = np.random.default_rng(4)
    monkeypatch.setattr(H, "BLOCK_ROWS", block)
    monkeypatch.setattr(H, "GROUP_ROWS", group)
    monkeypatch.setattr(H, "CELLS", cells)
    rows = [(int(i), r.normal(size=6).round(int(r.integers(0, 3))).tolist(), int(r.integers(-1, 3))) for i in range(-60, 340)]
    rows += [(400 + i, rows[60][1], 0) for i in range(60)]  # one vector again and again
    rows += [(500, None, 1), (501, [1.0] * 6, None), (502, [1.0, None, 1, 1, 1, 1], 1), (550, [float("nan")] * 6, 1), (551, [float("inf")] * 6, 1), (None, [1.0] * 6, 1), (600, [], 1), (601, [9.0, 9.0], 0), (650, [0.0] * 6, 7), (700, [-3.0] * 6, 8), (701, [3.0] * 6, 8)]
    found = H.hard_negatives(H.vectors(vectors(spark, rows))).collect()
    want = mined(rows)
    assert sorted(map(tuple, found)) == want and len({a for a, *_ in want}) > 5


def test_only_what_can_enter_is_scored_exactly():
    r = np.random.default_rng(1)
    v = np.floor(256 * r.normal(size=(2000, 16)) / 4).astype(np.int64)
    low = v.min(0)
    width = -(-(v.max(0) - low + 1) // H.CELLS)
    rows = pa.table({"row": range(2000), "vec_id": range(2000), "label": [0] * 2000, "v": v.tolist(), "cells": ((v - low) // width).tolist()})
    block, q = H.Block(rows, low, width), v[:20]
    lower, upper = block.bounds(q)
    exact = 2 * q @ v.T
    assert (lower <= exact).all() and (exact <= upper).all()
    scored: list[int] = []
    block_scores = H.Block.scores
    anchors = pa.table({"row": range(20), "vec_id": range(20), "label": [0] * 20, "v": q.tolist()})
    try:
        H.Block.scores = lambda self, a, x, y: scored.append(len(x)) or block_scores(self, a, x, y)
        assert H._positives(anchors, rows, low, width, 5).num_rows == 100
    finally:
        H.Block.scores = block_scores
    assert sum(scored) < 0.05 * 20 * 2000


def test_negatives_of_edge_tables(spark):
    assert H.hard_negatives(H.vectors(vectors(spark, []))).count() == 0
    assert H.hard_negatives(H.vectors(vectors(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]))).collect() == [(0, 1, 1, 2, 0, 0)]
    with pytest.raises(ValueError, match="64-bit"):
        H.hard_negatives(H.vectors(vectors(spark, [(0, [1e12], 1)])))
    twice = H.hard_negatives(H.vectors(vectors(spark, [(0, [1.0], 1), (0, [1.0], 1), (3, [0.75], 2)]))).collect()
    assert sorted(map(tuple, twice)) == [(0, 0, 1, 3, 65536, 49152)] * 2


def test_registered_queries_run(spark):
    assert QUERIES["op12_tokenizer_alignment"](spark, SF).count() == 200
