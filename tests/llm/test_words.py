import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from kollektiv.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x0c\ré漢.\xa0", max_size=30)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_runs_between_ascii_white_space(texts):
    w = W.Words(pa.array(texts, pa.string()))
    want = [(t or "").encode().split() for t in texts]
    assert [w.word(i) for i in range(len(w))] == [x for t in want for x in t]
    assert w.counts.tolist() == [len(x) for x in want]
    known = {}
    for i in range(len(w)):
        assert known.setdefault(w.word(i), w.hash[i]) == w.hash[i]
    assert len(set(known.values())) == len(known)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 7))
def test_gram_sets(texts, n):
    sets = W.text_sets(W.Words(pa.array(texts, pa.string()), lower=True), n)
    seen = {}
    for t, s in zip(texts, sets, strict=True):
        w = (t or "").encode().lower().split()
        grams = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        assert len(s) == len(grams) and np.all(s[1:] > s[:-1])
        assert seen.setdefault(frozenset(grams), s.tolist()) == s.tolist()


def test_slices_of_a_column_are_read_from_their_offset():
    column = pa.array(["a b", None, "c", "a b"]).slice(1)
    w = W.Words(column)
    assert [w.word(i) for i in range(len(w))] == [b"c", b"a", b"b"] and w.counts.tolist() == [0, 1, 2]


def test_byte_slices_cover_every_row_once():
    from kollektiv.llm.common import byte_slices
    b = pa.RecordBatch.from_arrays([pa.array(["x" * 50, None, "y" * 500, "", "z"])], ["text"])
    got = list(byte_slices(b, "text", 100))
    assert [v for s in got for v in s["text"].to_pylist()] == b["text"].to_pylist() and len(got) == 3
