from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import hardneg

SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, vector int, anchor string, rid int"


def brute(rows, every, positives=5, negatives=3, low=50, high=95):
    """rows: (id, vector, label), usable ones only."""
    width = max((len(v) for _, v, _ in rows), default=0)
    whole = sorted({(i, tuple(math.floor(256 * x) for x in v) + (0,) * (width - len(v)), lab) for i, v, lab in rows})
    out = []
    for a, own, label in whole:
        if a % every:
            continue
        scores = [(sum(x * y for x, y in zip(own, v)), i, lab) for i, v, lab in whole if i != a]
        liked = sorted((-s, i) for s, i, lab in scores if lab == label)[:positives]
        for s, p in liked:
            window = sorted((-t, i) for t, i, lab in scores if lab != label and low * -s <= 100 * t <= high * -s)
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(window[:negatives])]
    return sorted(out)


def found(spark, rows, every, **settings):
    df = spark.createDataFrame([(i, v, lab, "x", 1, "y", 2) for i, v, lab in rows], SCHEMA)
    ready = hardneg.labelled_integers(df, "vec_id", F.col("label"), "embedding", 256)
    return sorted(tuple(r) for r in hardneg.hard_negatives(ready, F.col("id") % every == 0, 5, 3, 50, 95, **settings).collect())


def clustered(seed, n, width=8, groups=6, spread=0.2):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(groups, width))
    return [(i, (centres[i % groups] + spread * random.normal(size=width)).tolist(), int(random.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_equals_brute_force(spark, spread):
    rows = clustered(1, 400, spread=spread)
    wanted = brute(rows, 20)
    assert len(wanted) > 100
    assert found(spark, rows, 20) == wanted
    assert found(spark, rows, 20, tree_rows=37, seed_rows=3, block_requests=7, broadcast_bytes=0) == wanted


def test_ties_copies_and_repeated_rows(spark):
    rows = [(i, [1.0, 0.5], i % 2) for i in range(200)] + [(7, [1.0, 0.5], 1), (300, [0.6, 0.3], 1), (301, [0.7, 0.3], 1)]
    assert found(spark, rows + rows[:50], 50) == brute(rows, 50)
    twice = rows + [(0, [0.9, 0.4], 0), (100, [2.0, 1.0], 1)]
    got, wanted = found(spark, twice, 50), brute(twice, 50)
    assert got == wanted


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.6, 0.5], 2), (3, [0.7], 2), (50, [-1.0, 0.3], 2), (51, [-0.5, 0.3], 1), (52, [0.0, 0.0], 2)]
    bad = [(4, None, 2), (5, [0.6, None], 2), (6, [nan, 0.1], 2), (7, [inf, 0.0], 2), (8, [0.6, 0.1], None), (None, [0.6, 0.1], 2), (None, None, None)]
    assert found(spark, good + bad, 50) == brute(good, 50)
    assert found(spark, [], 50) == []
    assert found(spark, bad, 50) == []
    assert found(spark, [(0, [1.0], 1)], 50) == []


def test_huge_components_stay_exact(spark):
    rows = [(0, [3e6, 1.0], 1), (1, [3e6, 0.5], 1), (2, [2.5e6, 0.25], 2), (3, [2.5e6, 0.5], 2), (50, [1e200, 0.0], 1), (51, [-1e200, 1.0], 2)]
    got = [r for r in found(spark, rows, 50) if r[0] == 0 and r[1] == 1]
    assert got == [r for r in brute(rows[:4], 50) if r[1] == 1]


def test_tree_covers_and_bounds():
    random = np.random.default_rng(2)
    rows = random.integers(-300, 300, (700, 6))
    rows[100:400] = rows[:30].repeat(10, axis=0) + random.integers(-3, 4, (300, 6))
    tree = hardneg.CoverTree(np.arange(700), random.integers(0, 3, 700), rows)
    anchors = random.integers(-300, 300, (15, 6))
    lengths = np.linalg.norm(anchors, axis=1)
    below = [{int(p)} for p in tree.point]
    for e in range(len(below) - 1, -1, -1):
        for child in range(tree.low[e], tree.high[e]):
            below[e] |= below[child]
    assert below[0] == set(range(700)) and sorted(tree.point[tree.fresh].tolist()) == list(range(700))
    inner = np.flatnonzero(tree.high > tree.low)
    least, most = tree.bounds(inner, (anchors @ rows[tree.point[inner]].T).astype(float), lengths)
    for n, e in enumerate(inner):
        scores = anchors @ rows[sorted(below[e])].T
        assert (scores.min(axis=1) >= least[:, n]).all() and (scores.max(axis=1) <= most[:, n]).all()
        for child in range(tree.low[e], tree.high[e]):
            assert tree.angle[child] <= tree.angle[e] + 1e-9


def test_descent_skips_nodes():
    """On clustered vectors a part of the products suffices."""
    random = np.random.default_rng(3)
    centres = random.normal(size=(60, 16))
    rows = np.floor(256 * (centres[np.arange(2000) % 60] + 0.02 * random.normal(size=(2000, 16)))).astype(np.int64)
    tree = hardneg.CoverTree(np.arange(2000), np.arange(2000) % 60 % 5, rows)
    n = 40
    vectors, none = rows[:n], np.full(n, hardneg.LEAST)
    ask = hardneg.Requests(np.arange(n), vectors, np.arange(n), tree.labels[:n], none, np.full(n, hardneg.MOST), none, 5, True)
    ask.search(tree)
    assert (ask.n == 5).all() and ask.scored < 0.5 * n * 2000
