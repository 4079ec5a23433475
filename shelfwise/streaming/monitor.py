"""Live request figures and exactly-once delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KPI_DELAY = "1 hour"


def kpis(events: DataFrame, window: str = "1 day", delay: str | None = KPI_DELAY) -> DataFrame:
    """Requests, errors and latency per tumbling window; with a delay the input is a stream."""
    timed = events.withWatermark("ts", delay) if delay else events
    return (
        timed.groupBy(F.window("ts", window).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("event_type") == "error").alias("errors"),
            F.sum(F.col("value").cast("decimal(18,2)")).alias("latency"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests", "errors", "latency")
    )


def closed_windows(batch: DataFrame, events: DataFrame, delay: str = KPI_DELAY) -> DataFrame:
    """The windows a stream that saw the same events has emitted."""
    newest = events.agg(F.max("ts")).scalar()
    return batch.filter(F.col("window_end") <= newest - F.expr(f"INTERVAL {delay}"))


def once_each(events: DataFrame, key: str, delay: str) -> DataFrame:
    """Drop re-delivered rows that arrive within `delay` of the first delivery."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])
