import brute
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbÉß漢 \n\t.0-\x0b\x1c"), max_size=40)), max_size=8)


def cut_all(texts, **options):
    return [(W.cut(data, offsets, **options), len(offsets) - 1) for _, data, offsets in W.slices(pa.array(texts, pa.string()), 16)]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    for options, want in (({}, lambda t: brute.SPACE_WORD.findall(t or "")), ({"separators": W.NOT_ALNUM, "fold": True}, lambda t: brute.ALNUM_WORD.findall(brute.fold(t)))):
        found = []
        for w, n in cut_all(texts, **options):
            found += [[bytes(w.data[s:e]).decode() for s, e in zip(w.starts[w.first[d] : w.first[d + 1]], w.ends[w.first[d] : w.first[d + 1]])] for d in range(n)]
        assert found == [want(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab "), max_size=30), min_size=1, max_size=6), st.integers(1, 4))
def test_equal_runs_have_equal_codes_and_others_dont(texts, k):
    seen: dict[bytes, int] = {}
    for w, _ in cut_all(texts):
        at, codes = w.runs(k)
        for i, c in zip(at.tolist(), codes.tolist()):
            assert seen.setdefault(w.joined(i, i + k), c) == c
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 9), st.integers(0, 60))
def test_winnowing_leaves_no_gap(values, width, border):
    codes, text = np.array(values, np.uint64), (np.arange(len(values)) >= border).astype(int)
    chosen = set(W.winnow(codes, text, width).tolist())
    for i in range(len(values) - width + 1):
        if text[i] == text[i + width - 1]:
            least = min(values[i : i + width])
            assert any(p in chosen and values[p] == least for p in range(i, i + width))


def test_covered_words():
    assert W.covered_words(6, np.array([0, 1, 4]), 2).tolist() == [True, True, True, False, True, True]
    assert W.per_text(np.array([1, 0, 1, 1]), np.array([0, 2, 2, 4])).tolist() == [1, 0, 2]
