"""Chat memory rolled up while turns arrive: keyed state, timers, and a flush when a session falls silent."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shelfwise import config
from shelfwise.operators.memory import leading_sentence

OUTPUT = "session string, bucket bigint, turns bigint, summarised boolean, content string"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class BucketRollup(StatefulProcessor):
    """State of one bucket of a session: its turns until it is full, then only that it was.

    The turn that fills the bucket gives its summary. A timer, `silence_ms` after the newest turn in event time, gives the
    turns of a bucket that was never filled, a row each, and drops the state of any bucket. A turn that is
    delivered again while the state lives changes nothing. A bucket's state never holds more than `every` turns.
    """

    def __init__(self, every: int, silence_ms: int):
        self.every, self.silence_ms = every, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.turns = handle.getMapState("turns", "turn bigint", "line string, content string")
        self.last = handle.getValueState("last", "ms bigint, full boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest, full = self.last.get() if self.last.exists() else (None, False)
        held = {turn[0] for turn in self.turns.keys()}
        for row in rows:
            newest = row.ms if newest is None else max(newest, row.ms)
            if full or row.turn in held:
                continue
            held.add(row.turn)
            self.turns.updateValue((row.turn,), (row.line, row.content))
            if len(held) == self.every:
                lines = sorted((turn[0], value[0]) for turn, value in self.turns.iterator())
                yield Row(session=key[0], bucket=key[1], turns=self.every, summarised=True, content=" ".join(line or "" for _, line in lines))
                self.turns.clear()
                full = True
        self.last.update((newest, full))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(newest + self.silence_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for _, value in sorted((turn[0], value) for turn, value in self.turns.iterator()):
            yield Row(session=key[0], bucket=key[1], turns=1, summarised=False, content=value[1])
        self.turns.clear()
        self.last.clear()

    def close(self) -> None:
        pass


def rollup_stream(turns: DataFrame, every: int = config.SUMMARY_EVERY, silence: int = 86_400, delay: str = "1 hour",
                  summarise=leading_sentence) -> DataFrame:
    """`memory.rollup` over a stream of session, turn, content and ts: (session, bucket, turns, summarised, content).

    `silence` is the seconds after which an unfinished bucket is given as it is; turns later than `delay` are not taken.
    """
    timed = turns.withWatermark("ts", delay).select(
        F.col("session").cast("string").alias("session"), F.floor(F.col("turn") / every).alias("bucket"), F.col("turn").cast("bigint").alias("turn"),
        summarise(F.col("content")).alias("line"), "content", F.unix_millis("ts").alias("ms"), "ts",
    )
    grouped = timed.groupBy("session", "bucket")
    return grouped.transformWithState(BucketRollup(every, 1000 * silence), OUTPUT, "Append", "EventTime")


def drain_rollup(turns: DataFrame, target: str, checkpoint: str, **settings) -> None:
    """Roll up everything that waits, append it to a parquet folder and return; state lives in the checkpoint."""
    spark = turns.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STATE_STORE)  # read when the query starts
    try:
        writer = rollup_stream(turns, **settings).writeStream.format("parquet").option("checkpointLocation", checkpoint)
        writer.outputMode("append").trigger(availableNow=True).start(target).awaitTermination()
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)
