"""A feed that gains columns, breaks types and holds broken lines."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from shelfwise.session import scratch_dir
from shelfwise.streaming.evolve import BAD, RESCUED, EvolvingFeed, new_columns


def test_described_objects():
    assert new_columns(None) == new_columns("VOID") == {}
    described = "OBJECT<a: BIGINT, `b c`: STRING, d: ARRAY<OBJECT<x: BIGINT, y: STRING>>, e: DECIMAL(3,2), f: VOID>"
    assert new_columns(described) == {"a": "bigint", "b c": "string", "d": "variant", "e": "double", "f": "variant"}


def test_nothing_is_lost(spark):
    landing, table, checkpoint = (scratch_dir(spark, n) for n in ("landing", "table", "checkpoint"))

    def run(*lines):
        spark.createDataFrame([(line if isinstance(line, str) else json.dumps(line),) for line in lines], "value string").coalesce(1).write.mode("append").text(landing)
        feed = EvolvingFeed(spark, landing, table, checkpoint, {"id": "bigint", "n": "bigint"})  # a new process
        feed.follow()
        return feed

    feed = run({"id": 1, "n": 5}, {"id": 2, "n": None}, {"id": 3}, "")
    assert feed.generations() == [{"id": "bigint", "n": "bigint"}]
    feed = run({"id": 4, "n": "many", "tag": "x", "deep": {"k": [1]}}, "{broken", "[1, 2]", {"id": 5, "n": 1})
    assert feed.generations()[-1] == {"id": "bigint", "n": "bigint", "deep": "variant", "tag": "string"}
    feed = run({"id": 6, "tag": "y", "deep": 3}, {"id": 7, "tag": {"not": "text"}})
    rows = {r.id: r for r in feed.read().select("id", "n", "tag", F.to_json("deep").alias("deep"), F.to_json(RESCUED).alias("aside"), BAD).filter("id IS NOT NULL").collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7]
    assert (rows[1].n, rows[2].n, rows[3].n, rows[5].n) == (5, None, None, 1) and rows[1].aside is None
    assert rows[4].tag == "x" and json.loads(rows[4].deep) == {"k": [1]} and json.loads(rows[4].aside)["n"] == "many"
    assert rows[6].tag == "y" and rows[6].deep == "3" and rows[6].aside is None
    assert json.loads(rows[7].tag) == {"not": "text"} or json.loads(rows[7].aside) == {"tag": {"not": "text"}}
    bad = sorted(r[BAD] for r in feed.read().filter(F.col(BAD).isNotNull()).collect())
    assert bad == ["[1, 2]", "{broken"]
    feed.follow()
    assert feed.read().count() == 9


def test_a_replayed_batch_takes_its_own_place(spark):
    landing, table, checkpoint = (scratch_dir(spark, n) for n in ("landing", "table", "checkpoint"))
    feed = EvolvingFeed(spark, landing, table, checkpoint, {"id": "bigint"})
    lines = spark.createDataFrame([('{"id": 1, "new": true}',)], "value string")
    feed._take(lines, 0)
    feed._take(lines, 0)
    assert [tuple(r) for r in feed.read().select("id", "new").collect()] == [(1, True)]
    assert len(feed.generations()) == 2
