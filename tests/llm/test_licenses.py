import random
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import docs_of

from kollektiv.llm import licenses as L


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=9))
def test_longest_increasing_subsequence(values):
    got = [values[i] for i in L.increasing(values)]
    assert all(a < b for a, b in zip(got, got[1:], strict=False))
    longest = max((len(c) for k in range(len(values) + 1) for c in combinations(values, k)
                   if all(a < b for a, b in zip(c, c[1:], strict=False))), default=0)
    assert len(got) == longest


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefg"), max_size=12), st.lists(st.sampled_from("abcdefg"), max_size=12))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = L.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    assert L.align(a, a) == [(i, i) for i in range(len(a))]


def test_notices_are_found_and_prose_is_not(spark):
    rnd = random.Random(1)
    vocab = "the of under license a work version and to free in is that this public".split() + [f"w{i}" for i in range(200)]
    prose = lambda n: " ".join(rnd.choices(vocab, k=n))
    rows = [(i, prose(rnd.randrange(0, 500))) for i in range(60)]
    plants = {}
    for i in range(0, 60, 3):
        k = (i // 3) % len(L.TEMPLATES)
        text = L.TEMPLATES[k][1]
        plants[i] = k
        rows[i] = (i, f"{prose(50)}\n{text.upper() if i % 2 else text}\n{prose(rnd.randrange(300))}")
    rows += [(100, None), (101, ""), (None, "Released under the MIT License."), (102, "Released  under the (MIT) license"), (103, "z " * 100_000)]
    got = {}
    for r in L.licenses(docs_of(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, k in plants.items():
        hit = [r for r in got[i] if r.template == k]
        assert hit and hit[0].license == L.TEMPLATES[k][0] and hit[0].coverage == 1.0
        # all words of the template stand between first and last
        assert hit[0].last_word - hit[0].first_word >= hit[0].n_words
    assert {r.license for r in got[None]} == {"MIT"} == {r.license for r in got[102]}
    # prose alone never covers 80 % of a notice word for word
    assert not [i for i in got if i is not None and i < 60 and i not in plants]


def test_changed_words_lower_the_coverage(spark):
    text = L.TEMPLATES[6][1].split()
    rows = [(i, " ".join("changed" if j % 7 == 3 and j < 7 * i else w for j, w in enumerate(text))) for i in range(5)]
    got = {r.doc_id: r.coverage for r in L.licenses(docs_of(spark, rows), templates=L.TEMPLATES[6:7]).collect()}
    for i in range(5):
        changed = sum(j % 7 == 3 and j < 7 * i for j in range(len(text)))
        assert abs(got[i] - (1 - changed / len(text))) < 0.02


def test_empty(spark):
    assert L.licenses(docs_of(spark, [])).count() == 0
    assert L.licenses(docs_of(spark, [(1, "a b")]), templates=[("x", ""), ("y", "?!")]).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=8), st.lists(st.sampled_from("abcd"), max_size=9))
def test_common_is_a_longest_common_subsequence(a, b):
    pairs = L.common(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    has = lambda c: all(x in it for it in [iter(b)] for x in c)
    assert len(pairs) == max(k for k in range(len(a) + 1) if any(has(c) for c in combinations(a, k)))


def test_notices_that_stand_twice_are_found(spark):
    rnd = random.Random(5)
    prose = lambda n: " ".join(f"w{rnd.randrange(400)}" for _ in range(n))
    rows, k = [], len(L.TEMPLATES)
    for i, gap in enumerate((0, 1, 5, 20)):
        rows += [(i * k + j, f"{prose(40 + j)} {text} {prose(gap)} {text} {prose(60)}") for j, (_, text) in enumerate(L.TEMPLATES)]
    got = {(r.doc_id, r.template): r for r in L.licenses(docs_of(spark, rows)).collect()}
    for i, _ in rows:
        hit = got[i, i % k]
        assert hit.coverage == 1.0 and (hit.first_word, hit.last_word) == (40 + i % k, 40 + i % k + hit.n_words)
