"""Mined negatives against scoring every pair."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kollektiv.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, score string, leaf string, row string"


def brute(rows):
    kept = [(i, lab, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, lab, v in rows
            if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    order = lambda x: (-x[1], x[0] is None, x[0])
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for n, (anchor, lab, v) in enumerate(kept):
        if anchor is None or anchor % 50:
            continue
        scored = [(i, dot(v, x), other) for m, (i, other, x) in enumerate(kept) if m != n]
        positives = sorted([(i, s) for i, s, other in scored if other == lab], key=order)[:5]
        for p, ps in positives:
            hard = sorted([(i, s) for i, s, other in scored if other != lab and 50 * ps <= 100 * s <= 95 * ps], key=order)[:3]
            out += [(anchor, p, r + 1, i, ps, s) for r, (i, s) in enumerate(hard)]
    return sorted(out, key=str)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    got = H.hard_negatives(H.quantised(df, F.col("label"), F.col("vec_id") % 50 == 0)).collect()
    return sorted((tuple(r) for r in got), key=str)


def vectors(n, dim, seed, kinds=4, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.4, (clusters, dim))
    return [(i, int(rng.integers(kinds)), (centres[rng.integers(clusters)] + rng.normal(0, 0.1, dim)).tolist()) for i in range(n)]


@pytest.fixture
def small(monkeypatch):
    """Many small leaves, deep trees and several blocks."""
    for name, value in (("SAMPLE", 64), ("ARITY", 3), ("LEAF_ROWS", 8), ("BLOCK", 4)):
        monkeypatch.setattr(H, name, value)


def test_equals_scoring_every_pair(spark):
    rows = vectors(600, 12, 1)
    assert mined(spark, rows) == brute(rows)


def test_small_leaves_ties_nulls_and_hot_vectors(spark, small):
    rng = random.Random(4)
    rows = vectors(330, 6, 2)
    rows += [(1000 + i, i % 3, [0.5, 0.25, 0.0, 0.0, -0.5, 0.125]) for i in range(150)]        # copies of one vector
    rows += [(2000 + i, 1, [rng.choice([-0.1, 0.1]) for _ in range(6)]) for i in range(60)]     # many ties
    rows += [(50, 1, [0.3] * 6), (50, 1, [0.3] * 6), (None, 1, [0.3] * 6), (None, 2, [0.28] * 6), (3050, 2, [0.2, 0.1]),
             (3051, None, [0.1] * 6), (3100, 1, None), (3150, 1, [None] * 6), (3200, 1, [float("nan")] * 6),
             (3250, 1, [float("inf")] * 6), (3300, 9, [0.4] * 6), (3350, 1, []), (3400, 1, [0.0] * 6), (3450, 2, [-0.4] * 6)]
    assert mined(spark, rows) == brute(rows)


def test_subtrees_are_passed_over_and_nothing_is_lost(small):
    """Bounds hold for every row of a leaf, and close anchors skip far leaves."""
    rows = np.array([v for _, _, v in vectors(400, 5, 7)])
    rows = np.floor(rows * 256).astype(np.int64)
    space = H.Space(int((rows * rows).sum(1).max()) + 1, 5)
    tree = H.Tree(space, rows[:64], 4)
    leaf = tree.leaves(rows)
    for at in np.unique(leaf):
        for node, child in tree.paths[at]:
            d = space.between(rows[leaf == at], tree.split_points(node))
            have = tree.ranges.get((node, child))
            low, high = (d.min(0), d.max(0)) if have is None else (np.minimum(have[0], d.min(0)), np.maximum(have[1], d.max(0)))
            tree.ranges[node, child] = low, high
    anchors = rows[:20]
    a = anchors.astype(float)
    away = np.sqrt(np.maximum((a * a).sum(1)[:, None] + space.top - 2 * a @ tree.points.T.astype(float), 0))
    skipped = 0
    for at in np.unique(leaf):
        low, high = tree.bounds(at, away)
        for row in rows[leaf == at]:
            real = space.reach(anchors, (anchors * row).sum(1))
            assert (low <= real).all() and (real <= high).all()
        best = np.sort(space.scores(anchors, rows), axis=1)[:, -5]
        skipped += int((low > space.reach(anchors, best)).sum())
    assert len(np.unique(leaf)) > 10 and skipped > 20


def test_large_components_use_integers():
    space = H.Space(1 << 60, 2)
    a = np.array([[(1 << 29) + 1, 3]])
    assert space.scores(a, a)[0, 0] == ((1 << 29) + 1) ** 2 + 9 and space.kind is np.int64


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [0.5]), (2, 2, [0.4])]) == []                    # no anchor
    assert mined(spark, [(50, 1, [0.5]), (51, 2, [0.4])]) == []                  # no positive
    assert mined(spark, [(50, 1, [0.5]), (51, 1, [0.5]), (52, 1, [0.4])]) == []  # one label
