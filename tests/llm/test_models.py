"""Toxicity and quality: held-out accuracy, and what the contracts fix."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import docs_of

from kollektiv.llm import quality as Q
from kollektiv.llm import toxicity as T


def corpus(n=900, seed=3):
    rnd = random.Random(seed)
    vocab = [f"word{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(n):
        toxic = i % 6 == 0
        w = rnd.choices(vocab, k=rnd.randrange(20, 80))
        if toxic:
            for _ in range(rnd.randrange(2, 5)):
                w[rnd.randrange(len(w))] = rnd.choice(["nasty", "vile,", "Rotten"])
        rows.append((i, " ".join(w)))
        marks.append((i, int(not toxic), int(toxic)))
    return rows, marks


def labels_of(spark, marks):
    return spark.createDataFrame([(*m, "x") for m in marks], "doc_id long, quality int, toxic int, text string")


def test_toxic_documents_are_told_apart(spark):
    rows, marks = corpus()
    extra = [(5000, None), (5001, ""), (None, "a nasty vile rotten text"), (5002, "?!"), (5003, "fine " * 100_000), (0, rows[0][1])]
    got = T.toxicity(docs_of(spark, rows + extra).repartition(4), labels_of(spark, [*marks, (None, 0, 1), (1, 1, None)])).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    for i, _ in rows:
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    held = [(by[i].predicted, t) for i, _, t in marks if by[i].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.97
    assert by[5000].score == by[5001].score == by[5002].score and by[None].predicted == 1 and not by[None].held_out


def test_scores_do_not_depend_on_held_out_labels_or_other_columns(spark):
    rows, marks = corpus(300)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in marks]
    first = {r.doc_id: r.score for r in T.toxicity(docs_of(spark, rows), labels_of(spark, marks)).collect()}
    second = {r.doc_id: r.score for r in T.toxicity(docs_of(spark, rows).repartition(5), labels_of(spark, flipped)).collect()}
    assert first.keys() == second.keys() and all(abs(first[k] - second[k]) < 1e-9 for k in first)


@pytest.mark.parametrize("run,column,cut", [(T.toxicity, 2, 0.5), (Q.quality, 1, 0.7)])
def test_few_labels(spark, run, column, cut):
    docs = docs_of(spark, [(i, f"some words {i}") for i in range(30)])
    none = run(docs, labels_of(spark, [(1, 1, 1)]).filter("doc_id < 0")).collect()
    assert {r.score for r in none} == {0.5}
    one = run(docs, labels_of(spark, [(i, 1, 1) for i in range(30)])).collect()
    assert all(r.score > 0.99 and r.predicted == 1 for r in one)
    assert run(docs_of(spark, []), labels_of(spark, [(1, 1, 1)])).count() == 0


def plain_model(rows, learnt, errors):
    """log P(word | toxic) / P(word | ordinary) in plain Python; None: any other word."""
    def contexts(texts):
        pairs = set()
        for t in texts:
            w = (t or "").lower().split()
            pairs |= {(w[k - 1] if k else None, x) for k, x in enumerate(w)}
        counts = {}
        for _, x in pairs:
            counts[x] = counts.get(x, 0) + 1
        return counts

    def taken(n, counts):
        of = [sum(min(c, 5) == k for c in counts.values()) for k in range(5)]
        if not of[1] or not of[2]:
            return min(n, max(0.5, errors * math.sqrt(n)))
        y = of[1] / (of[1] + 2 * of[2])
        d = [0, 0, 0, 0]
        for k in (1, 2, 3):
            d[k] = min(max(k - (k + 1) * y * of[k + 1] / of[k], 0.01), k) if of[k] else d[k - 1]
        return min(n, max(d[min(n, 3)], errors * math.sqrt(n)))
    shared = contexts(t for _, t in rows)
    total, p = sum(shared.values()) + 2, []
    for mark in (0, 1):
        own = contexts(t for i, t in rows if learnt.get(i) == mark)
        all_, left = sum(own.values()), sum(taken(n, own) for n in own.values())
        p.append(lambda x, own=own, all_=all_, left=left: (own.get(x, 0) - (taken(own[x], own) if x in own else 0)) / all_
                 + left / all_ * shared.get(x, 1) / total)
    classes = set().union(*(contexts([t]) for i, t in rows if i in learnt))
    return lambda x: math.log(p[1](x) / p[0](x)) if x in classes else math.log(p[1](None) / p[0](None))


@pytest.mark.parametrize("errors", [0.0, 1.5])
def test_scores_equal_a_plain_model(spark, monkeypatch, errors):
    """Thirty documents: evidence and score of each, against plain Python."""
    monkeypatch.setattr(T, "ERRORS", errors)
    rnd = random.Random(6)
    rows, marks = [], []
    for i in range(30):
        w = rnd.choices([f"tree{k}" for k in range(60)], k=rnd.randrange(1, 40))
        if i % 3 == 0:
            w += rnd.choices(["foul", "vile"], k=rnd.randrange(1, 9))
            rnd.shuffle(w)
        rows.append((i, " ".join(w)))
        if i < 24:
            marks.append((i, 1, int(i % 3 == 0)))
    rows += [(40, None), (41, "")]
    learnt = {i: t for i, _, t in marks if not T._for_curve(i)}
    ratio = plain_model(rows, learnt, errors)
    model = model_of(spark, rows, marks)
    for i, text in rows:
        r = [ratio(x) for x in (text or "").split()]
        peak = lambda k: max(sum(r[j:j + k]) / len(r[j:j + k]) for j in range(max(1, len(r) - k + 1)))
        want = [sum(r) / len(r), peak(3), peak(20), sum(r) / math.sqrt(len(r)), math.log(len(r))] if r else [0.0] * 5
        assert model.evidence(pa.array([text], pa.string()))[0].tolist() == pytest.approx(want, abs=1e-9), i
    scores = {r.doc_id: r.score for r in T.scored(docs_of(spark, rows), model).collect()}
    for i, text in rows:
        z = model.curve[0] + sum(c * e for c, e in zip(model.curve[1:], model.evidence(pa.array([text], pa.string()))[0], strict=True))
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-max(-500, min(500, z)))), abs=1e-9)


def test_shared_counts_are_of_distinct_contexts_in_every_document(spark):
    rows = [(1, "a b a b"), (2, "a b c b"), (3, "d b"), (None, "A b"), (4, None)]
    got = {r.word: r.contexts for r in T._continuations(docs_of(spark, rows).repartition(3)).collect()}
    pairs = {(w[k - 1] if k else None, x) for _, t in rows for w in [(t or "").lower().split()] for k, x in enumerate(w)}
    name = {T.letter_words(pa.array([x])).hash.view(np.int64)[0]: x for x in "abcd"}
    assert {name[w]: n for w, n in got.items()} == {x: sum(p[1] == x for p in pairs) for x in "abcd"}


def test_discounts(monkeypatch):
    n = np.repeat([0, 1, 2, 3, 4, 9], [5, 100, 40, 20, 10, 3])
    y = 100 / 180
    of = lambda: dict(zip(n.tolist(), T.discounts(n).tolist(), strict=True))
    assert of() == pytest.approx({0: 0, 1: 1, 2: 2, 3: 1.5 * 3 ** 0.5, 4: 3, 9: 4.5})
    monkeypatch.setattr(T, "ERRORS", 0.0)        # modified Kneser-Ney as it is
    assert of() == pytest.approx({0: 0, 1: 1 - 2 * y * 0.4, 2: 2 - 3 * y * 0.5, 3: 3 - 4 * y * 0.5, 4: 3 - 4 * y * 0.5, 9: 3 - 4 * y * 0.5})


def model_of(spark, rows, marks):
    known = T.marks(labels_of(spark, marks), "toxic")
    return T.train(docs_of(spark, rows).select("doc_id", "text"), known)


def test_a_rare_toxic_expression_adds_to_the_score(spark):
    rows, marks = corpus(600)
    seen = [i for i, _, t in marks if t and not T._for_curve(i)][:4]
    rows = [(i, t + " scarce" if i in seen else t) for i, t in rows]
    m = model_of(spark, rows, marks)
    plain, rare = m.evidence(pa.array(["word1 word2 unheard", "word1 word2 scarce"]))
    assert rare[1] > plain[1] + 0.5


def test_distinct_words_never_share_counts(spark):
    rows, marks = corpus(300)
    m = model_of(spark, rows, marks)
    odd = [f"odd{i}" for i in range(200_000)]
    alone, many = m.evidence(pa.array(["odd0", " ".join(odd)]))
    # words that no class has are the same evidence each
    assert alone[0] == pytest.approx(many[0]) and alone[0] == pytest.approx(many[1])


def test_quality_tells_noise_from_prose(spark):
    rnd = random.Random(8)
    rows, marks = [], []
    for i in range(800):
        words = [rnd.choice(["alpha", "beta", "gamma", "delta", "of", "the"]) + str(rnd.randrange(9)) for _ in range(rnd.randrange(20, 60))]
        bad = i % 4 == 0
        text = " ".join(w + rnd.choice(["%%%", "$$$", "&&&"]) for w in words) if bad else " ".join(words) + "."
        rows.append((i, text))
        marks.append((i, int(not bad), 0))
    got = Q.quality(docs_of(spark, [*rows, (9000, None), (9001, ""), (None, rows[1][1])]), labels_of(spark, marks)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 803 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [(by[i].predicted, q) for i, q, _ in marks if by[i].held_out]
    assert {i for i, _, _ in marks if by[i].held_out} == {i for i, _, _ in marks if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(p == q for p, q in held) / len(held) > 0.97 and by[9000].score == by[9001].score


def test_features_of_odd_texts_are_finite():
    x = Q.features(pa.array(["", None, " \n\t", "a", "\n\n|", "é" * 1000, "x " * 5000, "%%% &&&"]))
    assert x.shape == (8, len(Q.NAMES)) and np.isfinite(x).all()
    name = dict(zip(Q.NAMES, x[6], strict=True))
    assert name["same_as_before"] == pytest.approx(1 - 1 / 5000) and name["distinct"] == pytest.approx(1 / 5000)


def test_trees_step_towards_the_residuals():
    g, h = np.array([5.0, 5, -5, -5, 1]), np.full(5, 10.0)
    t = Q._tree(g, h)
    assert t[0] == t[1] > 0 > t[2] == t[3]
    grid, gain = Q._pair_tree(np.array([[9.0, -9], [-9, 9]]), np.full((2, 2), 9.0))
    assert gain > 0 and grid.tolist() == [[0.9, -0.9], [-0.9, 0.9]]


def test_pairs_learn_what_singles_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(Q.NAMES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = Q.fit(x, y, np.ones(len(y)))
    assert ((m.score(x) > 0.5) == y).mean() > 0.95
