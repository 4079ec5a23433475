from __future__ import annotations

import numpy as np
import pytest

from shelfwise.llm import vectordup

SCHEMA = "vec_id bigint, embedding array<float>, node string, code int, id string"


def brute(rows, threshold=0.9):
    """{(id, copy): (links, component, kept)} of rows (id, vector or None)."""
    width = max((len(v) for _, v in rows if v), default=1)
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    units = np.zeros((len(rows), width))
    for i in good:
        own = np.array(rows[i][1], np.float32).astype(float)
        units[i, : len(own)] = own / np.linalg.norm(own)
    linked = units @ units.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.arange(len(rows))
    for _ in range(len(rows)):
        now = np.where(linked, label[None, :], len(rows)).min(axis=1, initial=len(rows))
        now = np.minimum(label, now)
        if (now == label).all():
            break
        label = now
    smallest = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            smallest[label[i]] = min(smallest.get(label[i], id_), id_)
    parts = [smallest.get(label[i]) for i in range(len(rows))]
    return sorted((str(r[0]), int(linked[i].sum()), str(parts[i]), r[0] == parts[i]) for i, r in enumerate(rows))


def found(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], SCHEMA)
    got = vectordup.cosine_classes(df, "vec_id", "embedding", **settings).collect()
    return sorted((str(r.id), r.n_links, str(r.component_id), r.kept) for r in got)


def clustered(seed, groups, size, width=32, noise=0.25):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(groups, width))
    out = []
    for i in range(groups * size):
        own = centres[i % groups] + noise * random.normal(size=width) * (i % 4)
        out.append((i, [float(np.float32(x)) for x in own]))
    return out


def test_equals_brute_force(spark):
    rows = clustered(1, 30, 12) + [(1000 + i, v) for i, (_, v) in enumerate(clustered(1, 30, 2))]
    wanted = brute(rows)
    assert max(w[1] for w in wanted) > 3
    assert found(spark, rows) == wanted


def test_blocks_and_heavy_buckets_change_nothing(spark):
    rows = clustered(2, 3, 60, noise=0.1)
    wanted = brute(rows)
    assert found(spark, rows, bucket_nodes=8, block_nodes=16) == wanted
    assert found(spark, rows, bucket_nodes=2, block_nodes=5) == wanted


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.1, 0.0]), (3, None), (4, [1.0, None, 0.0]), (5, [nan, 1.0, 0.0]),
        (6, [inf, 0.0, 0.0]), (7, [0.0, 0.0, 0.0]), (8, [0.0, 0.0, 0.0]), (9, []), (None, [0.0, 1.0, 0.0]), (10, [0.0, 1.0]),
        (None, [0.0, 0.0, 1.0]), (11, [-1.0, 0.0, 0.0]), (12, [1e30, 0.0, 0.0]), (13, [-0.0, 1.0, 0.0]), (None, None),
    ]
    got = found(spark, rows)
    plain = [(i, v if v else None) for i, v in rows]
    assert [g[:3] for g in got] == [w[:3] for w in brute(plain)]
    assert all(kept for id_, _, part, kept in got if id_ == part)
    assert found(spark, []) == []
    assert found(spark, [(5, [1.0])]) == [("5", 0, "5", True)]


def test_one_group_of_copies(spark):
    rows = [(i, [0.5, 0.25, 0.1]) for i in range(3000)]
    assert found(spark, rows) == sorted((str(i), 2999, "0", i == 0) for i in range(3000))


@pytest.mark.parametrize("hashes", [1, 2, 3])
def test_recall_at_the_threshold(hashes):
    """Pairs at exactly the threshold meet in a bucket and pass the sketch."""
    random, width, n = np.random.default_rng(hashes), 64, 1500
    tables = vectordup.choose_tables(width, hashes, 0.9)
    one = random.normal(size=(n, width))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other = random.normal(size=(n, width))
    other -= (one * other).sum(axis=1, keepdims=True) * one
    other = 0.9 * one + np.sqrt(1 - 0.81) * other / np.linalg.norm(other, axis=1, keepdims=True)
    codes = [vectordup.bucket_codes(rows, tables, hashes, 8) for rows in (one, other)]
    met = (codes[0][:, :, None] == codes[1][:, None, :]).any(axis=(1, 2))
    bits = np.bitwise_count(vectordup.sketches(one) ^ vectordup.sketches(other)).sum(axis=1)
    assert (met & (bits <= vectordup.sketch_limit(0.9))).mean() > 0.995


def test_rotations_keep_lengths_and_hashes_grow_with_the_table():
    rows = np.random.default_rng(4).normal(size=(10, 16))
    assert np.allclose(np.linalg.norm(vectordup.rotate(rows, 7), axis=1), np.linalg.norm(rows, axis=1))
    assert [vectordup.choose_hashes(n, 64) for n in (1, 10_000, 10**6, 10**9)] == [1, 2, 3, 4]


def test_forest_connects_and_never_lists_pairs():
    random = np.random.default_rng(5)
    one, other = random.integers(0, 300, 400), random.integers(0, 300, 400)
    label = vectordup._reached(300, one, other)
    plain = np.arange(300)
    for _ in range(300):
        for a, b in zip(one, other):
            plain[a] = plain[b] = min(plain[a], plain[b])
    assert (label == plain).all()
