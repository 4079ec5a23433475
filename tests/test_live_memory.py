"""The live roll-up: equal to its batch twin over restarts, repeated turns counted once, silence flushes."""

from __future__ import annotations

from datetime import datetime, timedelta

from shelfwise.operators import memory
from shelfwise.session import scratch_dir
from shelfwise.streaming import memory as live

TURN = "session string, turn long, content string, ts timestamp"
START = datetime(2024, 1, 1)


def turns(spark, *rows):
    return spark.createDataFrame([(s, t, f"{s} says {t}. And more.", START + timedelta(minutes=at)) for s, t, at in rows], TURN)


def listed(df):
    return sorted(map(str, (tuple(r) for r in df.select("session", "bucket", "turns", "summarised", "content").collect())))


def test_stream_equals_batch_over_restarts(spark):
    landing, target, checkpoint = (scratch_dir(spark, n) for n in ("landing", "rollup", "checkpoint"))

    def drop(*rows):
        turns(spark, *rows).coalesce(1).write.mode("append").parquet(landing)
        live.drain_rollup(spark.readStream.schema(TURN).parquet(landing), target, checkpoint, every=3, silence=600)
        return spark.read.schema(live.OUTPUT).parquet(target)

    first = [("a", 0, 0), ("a", 2, 2), ("b", 0, 0), ("b", 1, 1), ("b", 2, 2), ("c", 4, 3)]
    rows = drop(*first)
    assert [r.session for r in rows.collect()] == ["b"]  # only the full bucket has spoken
    second = [("a", 1, 5), ("c", 3, 5), ("b", 1, 6), ("b", 3, 6)]  # b 1 once more
    rows = drop(*second)
    assert rows.filter("summarised").count() == 2
    drop(("z", 0, 10_000))
    distinct = turns(spark, *first, *[r for r in second if r[:2] != ("b", 1)])
    wanted = memory.rollup(distinct, "session", "turn", "content", every=3)
    got = spark.read.schema(live.OUTPUT).parquet(target)
    assert listed(got) == listed(wanted)
    drop(("a", 5, 20))  # long behind the watermark
    assert listed(spark.read.schema(live.OUTPUT).parquet(target)) == listed(wanted)
