"""Streams: nothing lost, nothing twice, late rows dropped, batch twin equal on closed windows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shelfwise.session import scratch_dir
from shelfwise.sources import files
from shelfwise.streaming import ingest, monitor

EVENT = "event_id long, ts timestamp, event_type string, value double"


def events(spark, first, last):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(hours=i), "error" if i % 5 == 0 else "view", float(i)) for i in range(first, last)]
    return spark.createDataFrame(rows, EVENT)


def test_files_land_once(spark):
    landing, bronze, checkpoint = (scratch_dir(spark, n) for n in ("landing", "bronze", "checkpoint"))
    for first in (0, 10):
        files.land_json(events(spark, first, first + 10), landing)
        for _ in range(2):
            ingest.ingest_files(spark, landing, bronze, checkpoint, as_of=F.lit("2024-03-01").cast("timestamp"))
    table = spark.read.parquet(bronze)
    assert {"path", "modificationTime", "length", "content", "ingestion_timestamp", "source_system"} == set(table.columns)
    assert table.groupBy("path").count().filter("count > 1").isEmpty()
    assert sorted(r.event_id for r in files.file_lines(table, EVENT).collect()) == list(range(20))
    ingest.ingest_files(spark, landing, bronze, checkpoint, glob="*.pdf")
    assert spark.read.parquet(bronze).count() == table.count()


def test_late_rows_and_closed_windows(spark):
    landing, target, checkpoint = (scratch_dir(spark, n) for n in ("landing", "kpis", "checkpoint"))

    def run():
        ingest.drain(monitor.kpis(ingest.json_rows(spark, landing, EVENT)), target, checkpoint)

    early, rest, late = events(spark, 0, 60), events(spark, 60, 100), events(spark, 3, 8).withColumn("event_id", F.col("event_id") + 1000)
    files.land_json(early, landing)
    run()
    files.land_json(late, landing)  # days behind the watermark
    files.land_json(rest, landing)
    run()
    streamed = spark.read.parquet(target)
    everything = early.unionByName(rest)
    batch = monitor.closed_windows(monitor.kpis(everything, delay=None), everything)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert streamed.count() == 4


def test_redelivery(spark):
    landing, target, checkpoint = (scratch_dir(spark, n) for n in ("landing", "events", "checkpoint"))
    for first, last in ((0, 50), (30, 80), (30, 80)):
        files.land_json(events(spark, first, last), landing)
        rows = ingest.json_rows(spark, landing, EVENT).drop("_corrupt")
        ingest.drain(monitor.once_each(rows, "event_id", "5 days"), target, checkpoint)
    assert sorted(r.event_id for r in spark.read.parquet(target).collect()) == list(range(80))


def test_corrupt_lines_are_kept(spark):
    landing, target = scratch_dir(spark, "landing"), scratch_dir(spark, "table")
    spark.createDataFrame([('{"event_id":1}',), ("{oops",)], "value string").write.text(landing)
    ingest.drain(ingest.json_rows(spark, landing, EVENT), target, scratch_dir(spark, "checkpoint"))
    got = {(r.event_id, r._corrupt) for r in spark.read.parquet(target).collect()}
    assert got == {(1, None), (None, "{oops")}
