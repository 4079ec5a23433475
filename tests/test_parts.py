"""Searches of a corpus in parts: equal to brute force, and only the k best rows of a question and part leave a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.functions import tiles
from shelfwise.operators import parts, search, vector_index


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def lists(rows):
    return vector_index._lists(np.asarray(rows, np.int64))


def table(rows, **columns):
    return pa.table({"id": pa.array(range(len(rows))), "vector": vector_index._lists(rows.astype(np.float32)), **columns})


@pytest.fixture
def small(monkeypatch):
    for name, value in {"SAMPLE_ROWS": 64, "TILE_ROWS": 50, "WAITING": 700, "PAIRS_AT_ONCE": 100, "SCORES_AT_ONCE": 2000}.items():
        monkeypatch.setattr(tiles, name, value)


@pytest.mark.parametrize("scopes, bits", [(None, None), (9, None), ((40, 3), None), ((40, 3), 7)])
@pytest.mark.parametrize("depth", [None, 12])
@pytest.mark.parametrize("copies", [0, 200])
def test_a_part_gives_what_brute_force_gives(small, monkeypatch, scopes, bits, depth, copies):
    random = np.random.default_rng(4)
    held, n = random.integers(-8, 9, (600, 8)).astype(float) + 0.1, 70
    held[:copies] = held[0]
    asked = unit(held[:n].astype(np.float32).astype(float))
    if bits:
        monkeypatch.setattr(tiles, "SCOPE_BITS", bits)
    columns, own, theirs = {}, np.zeros((600, 1), int), np.zeros((n, 1), int)
    if scopes:
        most, wide = scopes if isinstance(scopes, tuple) else (scopes, 1)
        own, theirs = random.integers(0, most, (600, wide)), random.integers(0, most, (n, 4))
        columns["scopes"] = lists(own)
    coarse = asked
    if depth:  # codes: the rounded rows
        codes = np.round(held).astype(np.int8).view(np.uint8)
        columns["code"] = pa.array([row.tobytes() for row in codes], pa.binary())
        columns.setdefault("scopes", lists(own))
        coarse = np.round(held[:n])
    decode = (lambda _, codes: codes.view(np.int8).astype(float)) if depth else None
    found = tiles.PartSearch(tiles.Part.of(table(held, **columns)), 4, depth, True, decode)
    question, ids, score, scored = found.search(pa.array(range(n)), asked, coarse, lists(theirs) if "scopes" in columns else None)
    got = {}
    for q, i, s in zip(question.tolist(), ids.to_pylist(), score.tolist()):
        got.setdefault(q, []).append((i, s))
    exact = np.round(asked @ unit(held.astype(np.float32).astype(float)).T, 6)
    total = 0
    for q in range(n):
        meet = [i for i in range(600) if i != q and set(own[i]) & set(theirs[q])]
        if depth:
            meet = sorted(meet, key=lambda i: (-float(np.round(held[i]) @ coarse[q]), i))[:depth]
        total += len(meet) if depth else 0
        wanted = sorted(meet, key=lambda i: (-exact[q, i], i))[:4]
        assert [i for i, _ in got.get(q, [])] == wanted
        assert np.allclose([s for _, s in got.get(q, [])], exact[q, wanted], atol=2e-6)
    assert not depth or scored.sum() == total


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "id long, vector array<float>").repartition(4)


def test_only_the_best_rows_of_a_part_are_written(spark, monkeypatch):
    monkeypatch.setattr(search, "CORPUS_BLOCK", 30)
    monkeypatch.setattr(vector_index, "CORPUS_BLOCK", 30)
    written = []
    for module in (parts, vector_index):
        put = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name, put=put: written.append((name, out := put(df, name))) or out)
    random = np.random.default_rng(2)
    df = frame(spark, random.standard_normal((300, 8)))
    listed = lambda found: sorted(tuple(r) for r in found.select("question_id", "rank", "id", "score").collect())
    wanted = listed(search.knn(df, df, 4, True, dim=8))
    assert not written
    assert listed(search.knn(df, df, 4, True, question_bytes=0, dim=8)) == wanted
    assert listed(search.knn_ivf(df, df, 9, 9, k=4, skip_same=True, question_bytes=0, dim=8)) == wanted
    plan = vector_index.Plan(1 << 10, 150)
    for index, settings in ((vector_index.knn_codes, {"cells": 5}), (vector_index.knn_multiprobe, {"dim": 8, "tables": 2})):
        found, _, scored = index(df, df, 4, skip_same=True, plan=plan, question_bytes=0, **settings)
        assert listed(found) == wanted and scored == 300 * 299
    rows = [out.count() for name, out in written if name != "sketches"]
    assert len(rows) == 4 * 3 and max(rows) <= 4 * 300


def test_cells_of_many_questions_are_not_listed_as_rows(spark, monkeypatch):
    random = np.random.default_rng(6)
    df = frame(spark, random.standard_normal((200, 8)))
    wanted = sorted(map(tuple, search.knn_ivf(df, df, 6, 2, k=3, skip_same=True, dim=8).collect()))
    monkeypatch.setattr(search, "nearest_cells", None)
    assert sorted(map(tuple, search.knn_ivf(df, df, 6, 2, k=3, skip_same=True, question_bytes=0, dim=8).select("question_id", "id", "score", "rank").collect())) == wanted
    assert search.knn_ivf(df, df.limit(0).union(df.limit(3)), 2, 2, k=3, question_bytes=0, dim=8).filter(F.col("rank") > 3).count() == 0
