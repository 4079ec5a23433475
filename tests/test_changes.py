"""Snapshots, partition rewrites and joins with hot keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import changes
from shelfwise.session import fits, hot_keys, scratch_dir, spread_join
from shelfwise.sources import files


def test_apply_of_diff_is_the_new_version(spark):
    one = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, "c")], "k long, s string, t string")
    two = spark.createDataFrame([(2, "b", "y"), (3, "c", None), (4, "d", "z")], "k long, s string, t string")
    feed = changes.change_feed(one, two, "k")
    kinds = sorted((r.k, r.change_type) for r in feed.collect())
    assert kinds == [(1, "delete"), (2, "update_post"), (2, "update_pre"), (3, "update_post"), (3, "update_pre"), (4, "insert")]
    assert sorted(map(tuple, changes.apply_changes(one, feed, "k").collect())) == sorted(map(tuple, two.collect()))
    assert changes.change_feed(one, one, "k").count() == 0


def test_rewrite_touches_only_its_partitions(spark):
    path = scratch_dir(spark, "table")
    rows = spark.createDataFrame([(i, i % 3) for i in range(9)], "id long, part int")
    files.overwrite(rows, path, "part")
    before = {r[0] for r in spark.read.parquet(path).filter("part = 0").select("_metadata.file_path").collect()}
    touched = spark.createDataFrame([(1,), (2,)], "part int")
    rebuild = lambda now: now.filter("part != 2 AND id != 1")
    for _ in range(2):  # a second run changes nothing
        files.rewrite_partitions(spark, path, "part", touched, rebuild)
        table = spark.read.parquet(path)
        assert sorted(r.id for r in table.collect()) == [0, 3, 4, 6, 7]
    after = {r[0] for r in spark.read.parquet(path).filter("part = 0").select("_metadata.file_path").collect()}
    assert before == after


def test_spread_join_with_a_hot_key(spark):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    small = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    assert [r.k for r in hot_keys(big, ["k"], 100).collect()] == [0]
    for how in ("inner", "left"):
        plain = big.join(small, "k", how)
        spread = spread_join(big, small, ["k"], ["id"], how, hot_rows=100)
        assert sorted(map(str, spread.select("id", "k", "v").collect())) == sorted(map(str, plain.select("id", "k", "v").collect()))
    salted = spread_join(big, small, ["k"], ["id"], "inner", hot_rows=100)
    assert salted.count() == big.join(small, "k").count()


def test_erasure_leaves_nothing(spark):
    docs = spark.range(10).select(F.col("id").alias("doc_id"))
    layers = {"documents": docs, "chunks": docs.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3))))}
    erased = docs.filter("doc_id < 4")
    assert {r.layer: r.rows_left for r in changes.residue(layers, erased, "doc_id").collect()} == {"documents": 4, "chunks": 12}
    after = changes.erase(layers, erased, "doc_id")
    assert {r.rows_left for r in changes.residue(after, erased, "doc_id").collect()} == {0}
    assert after["chunks"].count() == 18


def test_size_check_counts_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("a.b"), F.lit(None).cast("string").alias("c"))
    assert fits(df, 100) and not fits(df, 99) and not fits(df, 100, 99_999) and fits(df.limit(0), 0, 0)
