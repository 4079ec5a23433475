"""Threshold similarity join: equal to all pairs, whatever the cells and blocks, with few pairs scored in full."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import similar


def unit(rows):
    rows = rows.astype(np.float32).astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def frame(spark, rows, name=lambda i: i, kind="long"):
    return spark.createDataFrame([(name(i), [float(x) for x in r]) for i, r in enumerate(rows)], f"id {kind}, vector array<float>").repartition(3)


def clusters(n, dim, groups, spread, seed):
    random = np.random.default_rng(seed)
    centres = np.random.default_rng(0).standard_normal((groups, dim))
    return centres[random.integers(0, groups, n)] + spread * random.standard_normal((n, dim))


def all_pairs(asked, cache, threshold):
    scores = np.round(unit(asked) @ unit(cache).T, 6)
    return {(int(i), int(j)): float(scores[i, j]) for i, j in np.argwhere(scores >= threshold)}


@pytest.mark.parametrize("dim, groups, spread, threshold, cell_rows", [
    (16, 12, 0.3, 0.9, 25), (32, 300, 1.0, 0.4, 40), (4, 6, 0.2, 0.99, 10), (16, 12, 0.3, -1.0, 1000), (40, 3, 0.0, 1.0, 20),
])
def test_equals_all_pairs(spark, monkeypatch, dim, groups, spread, threshold, cell_rows):
    monkeypatch.setattr(similar, "ASKED_BLOCK", 16)
    monkeypatch.setattr(similar, "CACHE_BLOCK", 32)
    asked, cache = clusters(90, dim, groups, spread, 1), clusters(260, dim, groups, spread, 2)
    cache[:70] = cache[0]  # a third of the cache is one vector
    asked[:3] = cache[0]
    wanted = all_pairs(asked, cache, threshold)
    got = similar.similar_pairs(frame(spark, asked), frame(spark, cache), threshold, cell_rows=cell_rows).collect()
    assert len(got) == len({(r.question_id, r.id) for r in got})
    assert {(r.question_id, r.id) for r in got} == set(wanted)
    assert all(abs(r.score - wanted[r.question_id, r.id]) < 2e-6 for r in got)

    best = similar.similar_pairs(frame(spark, asked), frame(spark, cache), threshold, best=True, cell_rows=cell_rows).collect()
    top = {}
    for (question, other), score in wanted.items():
        top[question] = min(top.get(question, (0.0, 0)), (-score, other)) if question in top else (-score, other)
    assert {r.question_id: (-r.score, r.id) for r in best} == top


def test_cells_and_first_coordinates_leave_most_pairs_out(spark):
    asked, cache = clusters(200, 64, 60, 0.15, 1), clusters(1200, 64, 60, 0.15, 2)
    work = similar.similar_work(frame(spark, asked), frame(spark, cache), 0.9, cell_rows=20).first()
    assert work.found == len(all_pairs(asked, cache, 0.9)) > 0
    assert work.bounded <= 0.3 * work.pairs  # cells
    assert work.scored <= work.found + 0.01 * work.pairs
    # Without clusters the cells cannot help; the bound still does.
    random = np.random.default_rng(3)
    asked, cache = random.standard_normal((200, 64)), random.standard_normal((1200, 64))
    work = similar.similar_work(frame(spark, asked), frame(spark, cache), 0.75, cell_rows=100).first()
    assert work.pairs == 240_000 and work.scored <= 0.01 * work.pairs


def test_text_ids_and_empty_sides(spark):
    rows = frame(spark, clusters(30, 8, 3, 0.1, 1), lambda i: f"r{i:02d}", "string")
    none = rows.limit(0)
    assert similar.similar_pairs(rows, none, 0.5).count() == similar.similar_pairs(none, rows, 0.5).count() == 0
    assert similar.similar_work(rows, none, 0.5).first().asDict() == {"pairs": 0, "bounded": 0, "scored": 0, "found": 0}
    itself = similar.similar_pairs(rows, rows, 0.999999, best=True, cell_rows=7)
    assert {r.question_id for r in itself.collect()} == {f"r{i:02d}" for i in range(30)}


def test_cache_outcomes(spark):
    """A copy is exact, a neighbour near, anything else a miss; copies of a question share the outcome."""
    held = np.array([[1.0, 0, 0], [1.0, 0, 0], [0, 1.0, 0]])
    asked = np.array([[1.0, 0, 0], [0.1, 1.0, 0], [0.1, 1.0, 0], [0, 0, 1.0]])
    hashed = lambda df: df.withColumn("content_hash", F.md5(F.array_join(F.col("vector").cast("array<string>"), ",")))
    out = similar.semantic_cache(hashed(frame(spark, asked)), hashed(frame(spark, held)), 0.9, cell_rows=1)
    got = {r.id: (r.outcome, r.cached_id) for r in out.collect()}
    assert got == {0: ("exact", 0), 1: ("near", 2), 2: ("near", 2), 3: ("miss", None)}


def test_a_tile_the_bounds_do_not_thin_out_is_scored_by_one_product(monkeypatch):
    random = np.random.default_rng(8)
    rows = random.standard_normal((300, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    asked, held, axes = rows[:100], rows[100:], np.eye(64)

    def pairs(threshold):
        parts = list(similar.bounded_scores(asked, held, axes, threshold))
        return {(int(a), int(h)): s for part in parts for a, h, s in zip(*part[:3])}, sum(part[4] for part in parts)

    for threshold in (0.1, 0.35, 0.9):
        got, scored = pairs(threshold)
        assert (scored == 100 * 200) is (threshold < 0.9)
        monkeypatch.setattr(similar, "DENSE_SHARE", 0)
        assert pairs(threshold)[0] == got
        monkeypatch.undo()
        exact = np.round(asked @ held.T, 6)
        assert set(got) == set(zip(*(x.tolist() for x in np.nonzero(exact >= threshold))))


def test_pairs_left_by_the_first_bound_are_not_bounded_one_by_one(monkeypatch):
    """Without clusters most pairs pass the first bound; the next ones leave the same pairs, by products of tiles."""
    random = np.random.default_rng(9)
    rows = random.standard_normal((500, 64))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    asked, held = rows[:200], np.concatenate([rows[150:], rows[:40] + 0.01])
    held /= np.linalg.norm(held, axis=1, keepdims=True)
    one_by_one, einsum = [], np.einsum

    def work():
        one_by_one.clear()
        monkeypatch.setattr(similar.np, "einsum", lambda form, a, b: one_by_one.append(len(a)) or einsum(form, a, b))
        parts = list(similar.bounded_scores(asked, held, np.eye(64), 0.75))
        monkeypatch.setattr(similar.np, "einsum", einsum)
        return {(int(a), int(h)): s for part in parts for a, h, s in zip(*part[:3])}, sum(part[3] for part in parts), sum(part[4] for part in parts)

    monkeypatch.setattr(similar, "PAIRS_AT_ONCE", 1000)
    got = work()
    assert sum(one_by_one) <= 1000 + got[2]
    monkeypatch.setattr(similar, "OPEN_SHARE", 0)
    assert work() == got and sum(one_by_one) > 20_000
    exact = np.round(asked @ held.T, 6)
    assert set(got[0]) == set(zip(*(x.tolist() for x in np.nonzero(exact >= 0.75))))
