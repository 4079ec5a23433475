"""Summaries bound true counts, add up over days, and lead to the exact most frequent words."""

from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest

from shelfwise.operators import frequent
from shelfwise.session import scratch_dir


def words(days=6, n=400, seed=1):
    rng = random.Random(seed)
    return [(f"2024-01-0{d + 1}", f"w{int(rng.paretovariate(0.7)) % 300}") for d in range(days) for _ in range(n)]


@pytest.mark.parametrize("counters", [1, 5, 40, 1000])
def test_summary_bounds(counters):
    listed = [w for _, w in words()]
    s = frequent.Summary(counters)
    for low in range(0, len(listed), 97):
        s.add(pa.array(listed[low : low + 97]))
    true, held = Counter(listed), dict(zip(s.words.to_pylist(), s.counts.tolist()))
    assert len(held) <= counters and s.total == len(listed)
    assert s.error <= len(listed) / (counters + 1)
    for word, n in true.items():
        assert held.get(word, 0) <= n <= held.get(word, 0) + s.error


@pytest.mark.parametrize("counters", [3, 30, 4096])
def test_any_range_is_exact(spark, counters):
    rows = words() + [(None, "w1"), ("2024-01-02", None)]
    df = spark.createDataFrame(rows, "day string, word string").repartition(5)
    path = scratch_dir(spark, "summaries")
    frequent.store_days(df.filter("day <= '2024-01-03'"), "day", "word", path, counters)
    frequent.store_days(df.filter("day >= '2024-01-03'"), "day", "word", path, counters)  # the third day again
    stored = spark.read.schema("words array<string>, counts array<bigint>, error bigint, total bigint, day string").parquet(path)
    for first, last in (("2024-01-01", "2024-01-06"), ("2024-01-03", "2024-01-04"), ("2024-02-01", "2024-02-02")):
        true = Counter(w for d, w in rows if d and w and first <= d <= last)
        wanted = [(w, n, i + 1) for i, (w, n) in enumerate(sorted(true.items(), key=lambda x: (-x[1], x[0]))[:7])]
        got = frequent.most_frequent(df, stored, "day", "word", first, last, 7).orderBy("rank").collect()
        assert [tuple(r) for r in got] == wanted


def test_candidates_are_few(spark):
    df = spark.createDataFrame(words(4, 3000), "day string, word string").repartition(3)
    likely, complete = frequent.candidates(frequent.summarise(df, "day", "word", 200), 5)
    assert complete and 5 <= likely.count() < 60
