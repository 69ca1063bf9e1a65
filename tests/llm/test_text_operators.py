import json
import random

import brute
import numpy as np
import pytest
from helpers import SF, same_as_sql
from pyspark.sql import functions as F

from tideline.llm import bpe, decontamination, quality_rules, token_counts, toxicity
from tideline.llm.queries import ORACLES, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, words int"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, 0, "x", 1) for d, t, s in rows], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, name):
    same_as_sql(QUERIES[name](spark, SF), ORACLES[name])


# --- decontamination ---------------------------------------------------------------------------------

ITEMS = {1: " ".join(f"B{i}" for i in range(20)), 2: "short Item!", 3: None, 4: "", 5: "...", 12: " ".join(f"b{i}" for i in range(5, 25)), 7: "é漢"}


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS.items()] + [(1, ITEMS[1], "x"), (None, "never", "x")], "item_id long, text string, id string")


def texts() -> dict:
    r = random.Random(2)
    fill = lambda k: " ".join(r.choice("xyz") * r.randint(1, 4) for _ in range(k))
    return {1: ITEMS[1], 2: fill(40) + " " + " ".join(f"b{i}" for i in range(3, 18)) + " " + fill(40), 3: "a SHORT-item, twice: short item", 4: None, 5: "", 6: fill(3000) + " short item", 7: " ".join(f"b{i}" for i in range(12)), 8: "x é漢 y", 9: "never"}


def test_decontamination_is_brute_force(spark, benchmark):
    docs = table(spark, [(d, t, "s") for d, t in texts().items()])
    want = brute.contamination(texts(), {i: t for i, t in ITEMS.items()})
    for options in ({}, {"block_bytes": 40}):
        found = decontamination.scan(docs, benchmark, **options).select("id", "n_words", "n_hit", F.size("items"), F.sha2(F.concat_ws(",", "items"), 256), decontamination.is_contaminated(), "spans").collect()
        assert {r[0]: tuple(r)[1:6] for r in found} == want
        assert all(sum(s["last"] - s["first"] + 1 for s in r.spans) == r.n_hit for r in found)
        assert {r.doc_id for r in decontamination.decontaminate(docs, benchmark, **options).collect()} == {d for d, w in want.items() if not w[4]}
        assert decontamination.decontaminate(docs, benchmark, **options).columns == docs.columns
    cut = {r.id: r.text for r in decontamination.remove_spans(docs, benchmark).collect()}
    assert cut[3] == "a , twice: " and cut[4] is None and cut[9] == "never" and cut[6].endswith("x ") | cut[6].endswith("y ") | cut[6].endswith("z ")


def test_rows_of_one_id_or_none_are_judged_by_their_own_text(spark, benchmark):
    rows = [(1, ITEMS[1]), (1, "clean"), (1, "clean"), (None, ITEMS[12]), (None, "clean"), (2, None), (2, None)]
    docs = table(spark, [(d, t, "s") for d, t in rows])
    for options in ({}, {"block_bytes": 40}):
        found = decontamination.scan(docs, benchmark, **options).collect()
        assert sorted((r.id or 0, r.n_words, r.n_hit) for r in found) == [(0, 1, 0), (0, 20, 20), (1, 1, 0), (1, 1, 0), (1, 20, 20), (2, 0, 0), (2, 0, 0)]
        kept = decontamination.decontaminate(docs, benchmark, **options).collect()
        assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "clean"), (1, "clean"), (1, "clean"), (2, ""), (2, "")]
        cut = decontamination.remove_spans(docs, benchmark, **options).collect()
        assert sorted((r.id or 0, r.text or "") for r in cut) == [(0, ""), (0, "clean"), (1, ""), (1, "clean"), (1, "clean"), (2, ""), (2, "")]


def test_one_block_is_held_at_a_time(spark, benchmark, monkeypatch):
    docs, alive, held = table(spark, [(d, t, "s") for d, t in texts().items()]), [], []
    broadcast, stored = spark.sparkContext.broadcast, decontamination.stored
    kind = type(broadcast(1))
    destroy = kind.destroy
    monkeypatch.setattr(kind, "destroy", lambda self, blocking=False: (alive.remove(id(self)), destroy(self, blocking)))
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: (b := broadcast(x), alive.append(id(b)))[0])
    monkeypatch.setattr(decontamination, "stored", lambda df, name: (held.append(len(alive)), stored(df, name))[1])
    found = decontamination.scan(docs, benchmark, block_bytes=8)
    assert len(held) > 10 and set(held) == {1} and not alive
    assert {r.id: r.n_hit for r in found.collect()} == {d: w[1] for d, w in brute.contamination(texts(), dict(ITEMS)).items()}


def test_decontamination_of_nothing(spark, benchmark):
    docs = table(spark, [(1, "a b", "s"), (1, "a b", "s")])
    assert decontamination.scan(docs.limit(0), benchmark).collect() == []
    assert [(r.n_words, r.n_hit) for r in decontamination.scan(docs, benchmark.limit(0)).collect()] == [(2, 0)] * 2


# --- BPE ---------------------------------------------------------------------------------------------

HARD = ["a b  c\x1cd\x1e e  f\r\n\n x", "<|endoftext|>hi <|endoftext|> x<|endoftext|>", "日本語 テスト 123٣ ½ ²", "don't I'll WE'LL 's", "  lead", "trail  ", "\x85\x85a\u00a0\u2003b", "\u200b\u200bq", "👩‍👩‍👧 é ño", "", " ", "x" * 5000, "#$%" * 400, "\n" * 300, None]


def test_bpe_is_the_librarys(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.public_path())
    known = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    rows = {i: t for i, t in enumerate(HARD + known)}
    df = table(spark, [(i, t, "s") for i, t in rows.items()]).repartition(2)
    encoded = bpe.encode(df)
    for r in encoded.collect():
        want = library.encode(rows[r.id] or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == brute.sha(",".join(map(str, want)))
        assert r.decoded_sha256 == brute.sha(library.decode(want, skip_special_tokens=False))
    assert {r.id: r.text for r in bpe.decode(encoded).collect()} == {i: t or "" for i, t in rows.items()}
    assert bpe.encode(df, with_ids=False).columns == [c for c in encoded.columns if c != "ids"]


def test_bpe_forgets_without_changing_results(monkeypatch):
    small, large = bpe.BytePairEncoder(bpe.public_path(), 3000), bpe.encoder(bpe.public_path())
    for t in HARD[:10] * 2:
        assert small.encode(t) == large.encode(t)
    assert all(len(x) <= 4 for table in (small.known, small.tokens) for x in (table.newer, table.older))
    small = bpe.BytePairEncoder(bpe.public_path(), 3000)
    merged = []
    monkeypatch.setattr(small, "merge", lambda data, own=small.merge: merged.append(data) or own(data))
    for k in range(9):  # what is met again and again stays, although more than six others come along
        small.encode(f" common b{k}x")
    assert merged.count(b" common") == 1


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"pre_tokenizer": None}, {"decoder": None}, {"ignore_merges": True}, {"end_of_word_suffix": "</w>"}, {"type": "WordPiece"}, {"lstrip": True}])
def test_files_that_ask_for_more_are_refused(tmp_path, change):
    with open(bpe.public_path(), encoding="utf-8") as file:
        spec = json.load(file)
    assert bpe.unsupported(spec) == []
    (name,) = change
    (spec["added_tokens"][0] if name == "lstrip" else spec["model"] if name in ("ignore_merges", "end_of_word_suffix", "type") else spec).update(change)
    (tmp_path / "x.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="doesn't do"):
        bpe.BytePairEncoder(str(tmp_path / "x.json"))


def test_letters_are_letters_to_the_pattern_too():
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    assert len(letters) > 100_000
    assert all(bpe._PRE_TOKEN.findall(" " + "".join(letters[k : k + 500])) == [" " + "".join(letters[k : k + 500])] for k in range(0, len(letters), 500))


# --- token counts ------------------------------------------------------------------------------------


def test_histogram_answers_every_limit(spark):
    r = random.Random(1)
    lengths = [0, 0, 1, 5, 5, 300, 1023, 1024, 1025, 4000] + [r.randint(0, 3000) for _ in range(300)]
    hist = token_counts.histogram(spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, n_tokens long"))
    rows = hist.collect()
    assert {x.n_tokens for x in rows} == set(lengths)
    for x in rows:
        assert (x.docs, x.docs_over) == (lengths.count(x.n_tokens), sum(n > x.n_tokens for n in lengths))
        assert (x.tokens_over, x.tokens_truncated) == (sum(n for n in lengths if n > x.n_tokens), sum(min(n, x.n_tokens) for n in lengths))
        assert (x.docs_total, x.tokens_total) == (len(lengths), sum(lengths))
    for x in token_counts.at_limits(hist, [0, 7, 2048, 10**6]).collect():
        assert (x.docs_over, x.tokens_total, x.tokens_truncated) == (sum(n > x.context for n in lengths), sum(lengths), sum(min(n, x.context) for n in lengths))
    ordered = sorted(lengths)
    for x in token_counts.quantiles(hist, [0.0, 0.5, 0.99, 1.0]).collect():
        assert x.n_tokens == next(n for n in ordered if sum(m <= n for m in ordered) >= x.share * len(ordered))
    nothing = token_counts.histogram(spark.createDataFrame([], "id long, n_tokens long"))
    assert nothing.collect() == [] and [tuple(x) for x in token_counts.at_limits(nothing, [5]).collect()] == [(5, 0, 0, 0)]


def test_counts_are_the_encoders(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(40).unionByName(spark.createDataFrame([(-1, None, "", "", 0)], "doc_id long, text string, lang string, source string, n_chars long"))
    counts = {r.id: r.n_tokens for r in token_counts.token_counts(df).collect()}
    assert counts == {r.id: r.n_tokens for r in bpe.encode(df).select("id", "n_tokens").collect()}


# --- quality rules -----------------------------------------------------------------------------------


def test_frequent_lines_are_counted_by_host_and_removed(spark):
    good = lambda d: " ".join(chr(97 + d) * (i + 1) for i in range(30))
    rows = [(d, f"Cookie  Notice {d}\n{good(d)}", "a") for d in range(6)] + [(d, f"cookie notice 1\n{good(d)}", "b") for d in range(10, 12)]
    rows += [(20, "cookie notice 9\n" * 15, "a"), (21, None, "a"), (22, "", None), (23, good(23), None), (20, "cookie notice 9\n" * 15, "a")]
    df = table(spark, rows)
    found = {r.id: r for r in quality_rules.apply_rules(df, most_docs=3, most_share=0.1).collect()}
    assert found[0].n_line_words == 3 and found[0].kept and found[10].n_line_words == 0
    assert (found[20].n_line_words, found[20].n_dup_lines, found[20].base_failed, found[20].kept) == (45, 14, True, False)
    assert (found[21].n_words, found[21].kept, found[23].kept) == (0, False, True)
    assert quality_rules.apply_rules(df).count() == len(rows) and quality_rules.apply_rules(df.limit(0)).collect() == []
    texts = {r.id: r.text for r in quality_rules.remove_frequent_lines(df, most_docs=3, most_share=0.1).collect()}
    assert texts[0] == good(0) and texts[10] == f"cookie notice 1\n{good(10)}" and texts[21] is None


def test_repeated_windows(spark):
    for text in ("a b c d e f g h " * 3, "x " * 50, " ".join(f"w{i}" for i in range(40)), " ".join(map(str, range(12))) + " y " + " ".join(map(str, range(12))), "a " * 7):
        w = brute.SPACE_WORD.findall(text)
        runs = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        want = len({p for i, x in enumerate(runs) if runs.count(x) > 1 for p in range(i, i + 8)})
        assert quality_rules.base_rules(table(spark, [(1, text, "s")])).first().n_repeat_words == want


# --- toxicity ----------------------------------------------------------------------------------------


def test_toxic_sentences_are_learnt_from_documents(spark):
    r = random.Random(4)
    sentence = lambda k: " ".join(f"n{r.randint(0, 60)}" for _ in range(k)) + ". "
    rows, labels, where = [], [], {}
    for d in range(400):
        parts = [sentence(6) for _ in range(r.randint(1, 8))]
        bad = d % 4 == 0
        if bad:
            k = r.randrange(len(parts))
            parts[k] = f"you Awful{r.randint(0, 3)} thing. "
            where[d] = parts[k]
        rows.append((d, "".join(parts), "s"))
        labels.append((d, int(bad), "x"))
    rows += [(900, None, "s"), (901, "", "s"), (902, "awful1", "s"), (903, "n1 " * 5000 + "AWFUL2", "s")]
    docs = table(spark, rows)
    marked = spark.createDataFrame([*labels, (0, 1, "again"), (5000, 1, "no such document"), (None, 1, "x")], "doc_id long, toxic int, text string")
    train = marked.where(~toxicity.held_out())
    model = toxicity.train(docs, train)
    found = {r.id: r for r in toxicity.score(docs, model).collect()}
    held = {r.doc_id for r in marked.where(toxicity.held_out()).collect()}
    assert 60 < len(held) < 140
    for d, toxic, _ in labels:
        if d in held:
            assert (found[d].score >= toxicity.THRESHOLD) == bool(toxic)
            spans = [next(t for i, t, _ in rows if i == d)[s.start : s.end] for s in found[d].sentences]
            assert [x.strip() for x in spans] == ([where[d].strip()] if toxic else [])
    assert found[900].score == found[901].score < 0.1 and found[902].score > 0.3 and found[903].score > 0.3
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in found.items() if r.score < toxicity.THRESHOLD}
    assert toxicity.score(docs, toxicity.train(docs, train.limit(0))).agg(F.max("score")).first()[0] <= 0.001
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_noisy_or_blames_the_sentence_that_explains():
    model = toxicity.fit([(1, [[0], [1]]), (1, [[0]]), (0, [[1]]), (0, [[1], [1]])] * 20, ["bad", "fine"], 0.01)
    assert model.weights[0] > 1 and model.weights[1] < 0 and np.isfinite(model.bias)
