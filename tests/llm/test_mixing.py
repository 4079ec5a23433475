from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import mixing


def water(sizes, weights, total, cap):
    """Targets by clamping one source after another."""
    capped = {}
    while True:
        rest, free = total - sum(capped.values()), sum(w for s, w in weights.items() if s not in capped)
        targets = {s: capped.get(s, rest * w / free if free else 0) for s, w in weights.items()}
        over = [s for s in sizes if s not in capped and targets[s] > cap * sizes[s]]
        if not over:
            return targets
        capped |= {s: cap * sizes[s] for s in over}


def plan(spark, sizes, total, cap=2.0, weights=None):
    weights = weights or {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    df = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "source string, source_size bigint, weight int")
    return {r.source: r.target for r in mixing.fill(df, total, cap).collect()}, water(sizes, weights, total, cap)


@pytest.mark.parametrize(
    "sizes, total",
    [
        ({"a": 100, "b": 100, "c": 100}, 450),
        ({"a": 1, "b": 1000, "c": 10, "d": 5, "e": 700}, 2574),
        ({"a": 10, "b": 20}, 60),  # all at their caps
        ({"a": 10, "b": 20}, 600),  # beyond all caps
        ({"a": 0, "b": 20}, 30),
    ],
)
def test_fill(spark, sizes, total):
    got, wanted = plan(spark, sizes, total)
    assert got == pytest.approx(wanted)


def mixed(docs):
    sizes = mixing.sized(docs)
    return mixing.with_plan(sizes, mixing.mix_plan(sizes)).withColumn("copies", mixing.copies()).collect()


def test_sources_meet_their_targets(spark, documents):
    rows = mixed(documents)
    assert len(rows) == documents.count()
    assert sorted(rows, key=str) == sorted(mixed(documents), key=str)
    taken, target, largest = {}, {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        target[r.source], largest[r.source] = r.target, max(largest.get(r.source, 0), r.size)
        assert 0 <= r.copies <= 2
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)


def test_hot_source_and_odd_rows(spark, odd, empty):
    rows = mixed(odd)
    assert len(rows) == odd.count() and {r.source for r in rows} == {"a", "b", "c", None}
    assert {r.target for r in rows if r.source is None} == {2.0} and all(r.copies == 2 for r in rows if r.source is None)
    wordless = mixed(odd.withColumn("source", F.when(F.col("doc_id") == 4, "z").otherwise(F.col("source"))))
    assert [(r.target, r.copies) for r in wordless if r.source == "z"] == [(0.0, 0)]
    out = mixing.mix(odd)
    assert out.columns == odd.columns
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in out.collect())
    assert words == sum(r.size * r.copies for r in rows)
    assert mixing.mix(empty).count() == 0 and mixed(empty) == []


def test_own_weights(spark, documents):
    sizes = mixing.sized(documents)
    weights = sizes.select("source").distinct().withColumn("weight", F.when(F.col("source") == "src0", 100).otherwise(1))
    got = {r.source: r for r in mixing.mix_plan(sizes, 1.0, 2.0, weights).collect()}
    assert got["src0"].target == 2 * got["src0"].source_size and got["src0"].whole == 2


def test_main_path_is_native(spark, documents):
    plan = mixing.mix(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
