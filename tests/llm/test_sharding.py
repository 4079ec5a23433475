from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import ordering, sharding


@pytest.mark.parametrize("dimensions, bits", [(2, 1), (2, 3), (3, 2), (3, 4)])
def test_curve_visits_every_cell_and_steps_to_neighbours(spark, dimensions, bits):
    rows = sorted(sharding.curve_table(spark, dimensions, bits).collect(), key=lambda r: r.curve)
    assert [r.curve for r in rows] == list(range(1 << dimensions * bits))
    points = [[r.cell >> bits * i & (1 << bits) - 1 for i in range(dimensions)] for r in rows]
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(points, points[1:]))


def test_ranks_and_running_totals(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 5).alias("v"))
    ranks = [r.rank for r in sorted(ordering.ranked(df, [F.col("k").asc()]).collect())]
    assert ranks == list(range(5000))
    total = 0
    for r in sorted(ordering.running_total(df, [F.col("k").asc()], "v").collect(), key=lambda r: r.k):
        assert r.before == total
        total += r.v


def check(docs, placed, shards=sharding.SHARDS):
    assert len(placed) == docs.count()
    by_shard = {}
    for r in placed:
        by_shard.setdefault(r.shard, []).append(r.slot)
    counts = [len(by_shard.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    wanted = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.id, r.size, r.text_crc32) for r in placed) == wanted


def test_shards_hold_equal_counts(spark, documents):
    check(documents, sharding.assign_shards(documents).collect())


def test_odd_rows(spark, odd, empty):
    check(odd, sharding.assign_shards(odd).collect())
    out = sharding.shard_documents(odd)
    assert set(odd.columns) < set(out.columns) and out.count() == odd.count()
    assert sharding.assign_shards(empty).count() == 0 and sharding.shard_documents(empty).count() == 0


def test_copies_spread_over_shards(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("s").alias("source"), F.lit("en").alias("lang"))
    check(df, sharding.assign_shards(df).collect())


def test_shards_are_near_in_every_dimension(spark, documents):
    """A shard holds far fewer sources and languages than a shard of rows in id order would."""
    rows = sharding.shard_documents(documents).collect()
    per_shard = [len({r.source for r in rows if r.shard == s}) for s in range(sharding.SHARDS)]
    assert sum(per_shard) / len(per_shard) < 5
    assert Counter(r.shard for r in rows) == Counter(r.shard for r in sharding.assign_shards(documents).collect())


def test_main_path_is_native(spark, documents):
    plan = sharding.shard_documents(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
