import os

import brute
import corpus_pipeline as P
import pytest
from helpers import SF
from tokenizers import Tokenizer

from tideline.llm import bpe, tables, toxicity
from tideline.llm.tables import table


def test_stages_take_effect_one_after_the_other(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        if k < len(P.STAGES) - 1:
            assert out.columns == columns and out.dtypes == docs.dtypes, name
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and (name not in ("substrings", "tokens") or left == ids)
        ids = left
    assert 0 < len(ids) < 200 and [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "substrings", "decontamination", "tokens"]
    assert {r.doc_id for r in P.run(spark, SF).select("doc_id").collect()} == ids


def test_nothing_in_nothing_out(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).collect() == []
    assert toxicity.THRESHOLD == 0.3


def test_each_stage_is_brute_force(spark, tmp_path):
    docs = table(spark, SF, "documents").limit(120).unionByName(spark.createDataFrame([(-3, None, "en", "s", 0), (-2, "", "en", "s", 0), (-1, " \n", None, None, 2)], table(spark, SF, "documents").schema))
    docs.write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    items = {r.item_id: r.text for r in table(spark, SF, "benchmark").collect()}
    library = Tokenizer.from_file(bpe.public_path())
    for k, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name == "tokens":
            want = {d: library.encode(t or "", add_special_tokens=False).ids for d, t in before.items()}
            assert {r.doc_id: r.ids for r in docs.collect()} == want
            continue
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "near_duplicates":
            assert after == {d: before[d] for d, (_, c) in brute.classes(before).items() if c == d}
        elif name == "substrings":
            lost = brute.repeats(before)
            assert {d: brute.sha(" ".join(brute.SPACE_WORD.findall(t or ""))) for d, t in after.items()} == {d: sha for d, (_, _, sha) in lost.items()}
            assert all(after[d] == before[d] for d, (_, n, _) in lost.items() if not n)
        elif name == "decontamination":
            assert after == {d: before[d] for d, found in brute.contamination(before, items).items() if not found[4]}
        else:
            assert set(after.items()) <= set(before.items()) and {-3, -2, -1} <= set(after)


def test_stages_take_null_ids_and_repeated_ids(spark):
    long = " ".join(f"w{i}" for i in range(70))
    rows = [(1, long, "en", "s", 9), (1, long, "en", "s", 9), (1, "other words here", None, None, None), (None, long, "en", "s", 1), (None, None, None, None, None), (2, long + " x y", "en", "s", 2)]
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").schema)
    for name, stage in P.STAGES[:4]:
        kept = sorted((r.doc_id or 0, r.text or "") for r in stage(spark, docs, SF).collect())
        if name in ("toxicity", "decontamination"):
            assert len(kept) == len(rows)
        elif name == "near_duplicates":
            assert [i for i, _ in kept] == [0, 0, 1, 1, 1]
        else:
            assert (2, "x y") in kept and kept.count((1, long)) == 2 and (0, long) in kept
    assert P.STAGES[4][1](spark, docs, SF).count() == len(rows)


def test_stages_take_further_columns_and_very_long_texts(spark):
    long = " ".join(f"w{i % 7919}x{i % 104729}" for i in range(120_000))
    more = "id string, ID2 string, Own_Text string, text_hash int, dropped string, own_dropped string, words int, bucket string, score double, rows string"
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + more
    docs = spark.createDataFrame([(d, t, "en", "s", len(t), "a", "b", "c", 1, "d", "e", 2, "f", 0.5, "g") for d, t in ((1, long), (2, long + " tail of it"), (3, "short one"))], schema)
    left = {"near_duplicates": [1, 3]}
    for name, stage in P.STAGES[:4]:
        out = stage(spark, docs, SF)
        found = out.orderBy("doc_id").collect()
        assert out.columns == docs.columns and [r.doc_id for r in found] == left.get(name, [1, 2, 3])
        assert all(tuple(r)[5:] == ("a", "b", "c", 1, "d", "e", 2, "f", 0.5, "g") for r in found)
        if name == "substrings":
            assert [r.text for r in found] == [long, "tail of it", "short one"] and [r.n_chars for r in found] == [len(long), 10, 9]
    tokens = {r.doc_id: r for r in P.STAGES[4][1](spark, docs, SF).collect()}
    assert tokens[1].decoded_sha256 == brute.sha(long) and tokens[1].n_tokens == len(tokens[1].ids) > 200_000


def test_intermediate_folders(spark, tmp_path):
    kept = tables.stored(spark.range(3).toDF("id"), "some")
    path = tables._made[-1]
    assert kept.count() == 3 and os.path.isdir(path.removeprefix("file:"))
    tables.clear(spark)
    assert not os.path.exists(path.removeprefix("file:")) and not tables._made


def test_a_cluster_needs_a_shared_folder():
    class Unset:
        class _jsc:
            sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("D", (), {"isDefined": staticmethod(lambda: False)}))}))

        master = "spark://somewhere"
        conf = {}

    session = type("Session", (), {"sparkContext": Unset, "conf": {}})
    with pytest.raises(ValueError, match="share"):
        tables.shared_dir(session)
