from __future__ import annotations

import random
import re
from fractions import Fraction

import pytest

from shelfwise.llm import graph, neardup


def shingles(text, size=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    if not words:
        return frozenset([("text", text)])
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, threshold=Fraction(4, 5)):
    """Sorted (id, class_id, n_links, n_text_links, n_copies) by comparing all pairs of rows."""
    sets = [None if t is None else shingles(t) for _, t in rows]
    index = list(range(len(rows)))
    links = [[] for _ in rows]
    for i in index:
        for j in range(i):
            if sets[i] is not None and sets[j] is not None:
                common = len(sets[i] & sets[j])
                wordless = any(isinstance(g, tuple) and g[0] == "text" and len(g) == 2 for g in sets[i] | sets[j])
                if sets[i] == sets[j] or (not wordless and common >= threshold * len(sets[i] | sets[j])):
                    links[i].append(j)
                    links[j].append(i)
    root = index[:]

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in index:
        for j in links[i]:
            root[find(i)] = find(j)
    out = []
    for i, (own, text) in enumerate(rows):
        members = [rows[j][0] for j in index if find(j) == find(i)]
        named = [m for m in members if m is not None]
        different = {sets[j] for j in links[i]} - {sets[i]}
        copies = 1 if sets[i] is None else sum(s == sets[i] for s in sets)
        out.append((own, min(named) if named else None, len(links[i]), len(different), copies))
    return sorted(out, key=str)


def found(df, **settings):
    rows = neardup.jaccard_classes(df, **settings).collect()
    return sorted(((r.id, r.class_id, r.n_links, r.n_text_links, r.n_copies) for r in rows), key=str), rows


def near_copies(seed, groups, size, words=80, changes=6):
    draw = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{draw.randrange(400)}" for _ in range(words)]
        for _ in range(size):
            own = base[:]
            for _ in range(draw.randrange(changes)):
                own[draw.randrange(words)] = f"x{draw.randrange(10**6)}"
            rows.append(" ".join(own))
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("blocks", [{}, {"block_shingles": 700, "block_nodes": 6}])
def test_equals_all_pairs(spark, blocks):
    rows = near_copies(1, 6, 25) + [(1000 + i, t) for i, t in near_copies(2, 20, 2)] + [(2000, "a b c"), (2001, "A b, c"), (2002, "a b c d")]
    got, _ = found(spark.createDataFrame(rows, "doc_id bigint, text string"), **blocks)
    assert got == brute(rows)
    assert any(r[3] > 3 for r in got)


@pytest.mark.parametrize("blocks", [{}, {"block_shingles": 700, "block_nodes": 6}])
def test_repeated_rows_of_large_groups_count_once(spark, blocks):
    rows = [row for i, row in enumerate(near_copies(3, 3, 20)) for _ in range(7 if i % 3 == 0 else 1)]
    got, _ = found(spark.createDataFrame(rows, "doc_id bigint, text string"), **blocks)
    assert got == brute(rows)


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got, whole = found(odd)
    assert got == brute(rows)
    assert sum(r.stays for r in whole) == 10 + 1  # one row value of each class; one of these is there twice
    kept = neardup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 3, 4, 5, 6, None, None, 8, 9, 10]))
    assert found(empty)[0] == [] and neardup.drop_near_duplicates(empty).count() == 0


def test_one_of_each_class_stays(spark, documents):
    rows = neardup.jaccard_classes(documents).collect()
    kept = {r.doc_id for r in neardup.drop_near_duplicates(documents).collect()}
    assert kept == {r.class_id for r in rows} and len(kept) < len(rows)
    again = documents.unionByName(documents)
    assert {r.doc_id for r in neardup.drop_near_duplicates(again).collect()} == kept
    assert neardup.drop_near_duplicates(again).count() == len(kept)


def test_hot_group_makes_linear_rows(spark):
    """Near copies of one text: candidate edges and verified rows grow with the group, not its square."""
    df = spark.createDataFrame(near_copies(3, 1, 400, words=200, changes=4), "doc_id bigint, text string")
    rows = neardup.jaccard_classes(df).collect()
    assert len({r.class_id for r in rows}) == 1 and sum(r.n_links for r in rows) > 100_000
    bands, per = neardup.choose_bands(0.8)
    signed = neardup.sign(df, "doc_id", "text", 5, bands, per)
    edges = neardup.candidate_edges(signed.selectExpr("id AS node", "bands"))
    assert edges.count() < bands * 400


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.95):
        bands, rows = neardup.choose_bands(threshold, 0.999, 400)
        assert 1 - (1 - threshold**rows) ** bands >= 0.999 and bands * rows <= 400
    with pytest.raises(ValueError):
        neardup.choose_bands(0.05, 0.9999, 10)


def test_components(spark):
    draw = random.Random(4)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 160)]
    some = [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(60)]
    edges = chain + star + some
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    wanted = {(i, find(i)) for i in list(root) if find(i) != i}
    assert {tuple(r) for r in graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()} == wanted
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
