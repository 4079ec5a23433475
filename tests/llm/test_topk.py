from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import topk


def brute(vectors, every, k):
    rows = sorted(set((i, tuple(math.floor(256 * x) for x in v)) for i, v in vectors))
    out = []
    for q, own in rows:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, every, k, **settings):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, id string, vector int")
    vectors = topk.integer_vectors(df, "vec_id", "embedding", 256)
    return sorted(tuple(r) for r in topk.top_k(vectors, F.col("id") % every == 0, k, **settings).collect())


@pytest.mark.parametrize("spread", [0.01, 1.0])
def test_equals_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(topk, "LEAF_ROWS", 4)
    random = np.random.default_rng(1)
    centres = random.normal(size=(5, 6))
    vectors = [(i, [float(np.float32(x)) for x in centres[i % 5] + spread * random.normal(size=6)]) for i in range(300)]
    rows = [(i, v, "x", 1) for i, v in vectors]
    wanted = brute(vectors, 7, 5)
    assert found(spark, rows, 7, 5) == wanted
    assert found(spark, rows, 7, 5, query_block=10, seed_rows=3) == wanted


def test_bounds_hold():
    random = np.random.default_rng(2)
    rows, queries = random.integers(-300, 300, (500, 8)), random.integers(-300, 300, (20, 8))
    tree = topk.BallTree(np.arange(500), rows)
    bounds = tree.bounds(queries.astype(float))
    for leaf, (low, high) in enumerate(tree.leaves):
        assert (topk.inner_products(queries, tree.rows[low:high]).max(axis=1) <= bounds[:, leaf]).all()
    assert sorted(tree.ids.tolist()) == list(range(500))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (50, [0.5]), (51, [-1.0, 2.0])]
    bad = [(3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0])]
    rows = [(i, v, None, None) for i, v in good + bad]
    padded = [(i, v + [0.0] * (2 - len(v))) for i, v in good]
    assert found(spark, rows, 50, 5) == brute(padded, 50, 5)
    assert found(spark, [], 50, 5) == []
    assert found(spark, [(0, [1.0], None, None)], 50, 5) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [3e5, 1.0], None, None), (1, [3e5, 0.5], None, None), (2, [3e5, 0.25], None, None)]
    assert found(spark, rows, 50, 2) == brute([(i, v) for i, v, _, _ in rows], 50, 2)


def test_copies_of_one_vector(spark):
    rows = [(i, [0.5, 0.25], None, None) for i in range(1000)]
    got = found(spark, rows, 500, 5)
    assert [g[2] for g in got] == [1, 2, 3, 4, 5, 0, 1, 2, 3, 4]
