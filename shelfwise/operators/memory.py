"""Chat memory: stored messages, histories, windows and summaries.

One session may hold a large share of all messages, so no window ever spans a whole session: turns
are cut into blocks, numbered inside a block, and shifted by the size of the blocks before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import text as ft
from shelfwise.session import spread_join

# Turns numbered by one window.
BLOCK_TURNS = 10_000
MESSAGE = "struct<role:string,content:string>"


def to_messages(turns: DataFrame, session: str, turn: str, role: str, content: str, timestamp: Column) -> DataFrame:
    """Rows of the chat log: session_id, turn, message_json, timestamp."""
    body = F.to_json(F.struct(F.col(role).alias("role"), F.col(content).alias("content")))
    return turns.select(F.col(session).alias("session_id"), F.col(turn).alias("turn"), body.alias("message_json"), timestamp.alias("timestamp"))


def load_session(log: DataFrame, session_id: object) -> DataFrame:
    """Decoded messages of one session, oldest first; equal timestamps fall back to the turn."""
    return decoded(log.filter(F.col("session_id") == F.lit(session_id))).orderBy("timestamp", "turn")


def decoded(log: DataFrame) -> DataFrame:
    return log.withColumn("m", F.from_json("message_json", MESSAGE)).select("session_id", "turn", "timestamp", "m.role", "m.content")


def numbered(turns: DataFrame, session: str, order: str, block: int = BLOCK_TURNS) -> DataFrame:
    """Every message with its position in its session; `order` is the turn number, unique there."""
    blocked = turns.withColumn("_block", F.floor(F.col(order) / block))
    earlier = W.partitionBy(session).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sizes = blocked.groupBy(session, "_block").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(session, "_block", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy(session, "_block").orderBy(order))
    return (
        blocked.withColumn("_inside", inside)
        .join(offsets, [session, "_block"])
        .withColumn("position", F.col("_before") + F.col("_inside"))
        .drop("_block", "_inside", "_before")
    )


def clear_session(log: DataFrame, session_id: object) -> DataFrame:
    return log.filter(~F.col("session_id").eqNullSafe(F.lit(session_id)))


def last_interactions(turns: DataFrame, session: str, order: str, k: int = config.MEMORY_WINDOW) -> DataFrame:
    """Messages of the last k interactions, the newest numbered 1; a user message starts one.

    The k newest user messages are found by a pruned top-k and give each session its cut-off;
    only the messages after it reach the numbering window.
    """
    newest = W.partitionBy(session).orderBy(F.desc(order))
    asked = turns.filter("role = 'user'").select(session, order).withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= k)
    cutoff = asked.groupBy(session).agg(F.min(order).alias("_from"), F.max("_r").alias("_asked"))
    # A session with fewer than k interactions keeps what came before its first one as well.
    start = F.when(F.col("_asked") < k, F.lit(None)).otherwise(F.col("_from"))
    recent = spread_join(turns, cutoff.withColumn("_from", start), [session], [order], "left").filter(
        F.col("_from").isNull() | (F.col(order) >= F.col("_from"))
    )
    asked_since = F.sum((F.col("role") == "user").cast("int")).over(newest)
    return recent.withColumn(
        "interaction", F.when(F.col("role") == "user", asked_since).otherwise(asked_since + 1)
    ).filter(F.col("interaction") <= k).drop("_from", "_asked")


def leading_sentence(content: Column) -> Column:
    """Stand-in summary of a message: its text up to the first full stop."""
    return F.regexp_extract(content, r"^([^.]*\.?)", 1)


def rollup(
    turns: DataFrame, session: str, order: str, content: str, every: int = config.SUMMARY_EVERY,
    summarise: Callable[[Column], Column] = leading_sentence,
) -> DataFrame:
    """One summary row per full bucket of `every` turns; the other turns stay as they are, a row each.

    A window spans one bucket, so never more than `every` turns.
    """
    bucket = W.partitionBy(session, "bucket")
    counted = turns.withColumn("bucket", F.floor(F.col(order) / every)).withColumn("_n", F.count(F.lit(1)).over(bucket))
    line = F.struct(F.col(order).alias("o"), summarise(F.col(content)).alias("s"))
    full = counted.filter(F.col("_n") == every).groupBy(session, "bucket").agg(
        F.count(F.lit(1)).alias("turns"), F.array_sort(F.collect_list(line)).alias("lines")
    )
    summaries = full.select(
        session, "bucket", "turns", F.lit(True).alias("summarised"),
        F.array_join(F.transform("lines", lambda x: x["s"]), " ").alias("content"),
    )
    raw = counted.filter(F.col("_n") < every).select(
        session, "bucket", F.lit(1).cast("bigint").alias("turns"), F.lit(False).alias("summarised"), F.col(content).alias("content")
    )
    return summaries.unionByName(raw)


def history_prompts(
    turns: DataFrame, session: str, order: str, system: str, k: int = config.MEMORY_WINDOW, block: int = BLOCK_TURNS
) -> DataFrame:
    """Prompt of every user message: system line, the last k messages before it, the message.

    Windows span one block of positions; the last k messages of a block are repeated ahead of the
    next one, so no history is cut at a block border.
    """
    at = F.col("position") - 1
    own = F.floor(at / block)
    blocks = F.when(at % block >= block - k, F.array(own, own + 1)).otherwise(F.array(own))
    placed = numbered(turns, session, order).withColumn("_own", own).withColumn("_block", F.explode(blocks))
    speaker = F.when(F.col("role") == "user", "User: ").when(F.col("role") == "assistant", "AI: ").otherwise("System: ")
    before = W.partitionBy(session, "_block").orderBy("position").rowsBetween(-k, -1)
    history = F.array_join(F.collect_list(F.concat(speaker, F.col("text"))).over(before), "\n")
    return (
        placed.withColumn("history", history)
        .filter((F.col("role") == "user") & (F.col("_own") == F.col("_block")))
        .select(
            session, order,
            F.concat(F.lit(f"System: {system}\nHistory: \n"), F.col("history"), F.lit("\nCurrent: "), F.col("text")).alias("prompt"),
        )
    )


def chat_analytics(turns: DataFrame, session: str, content: str) -> DataFrame:
    """Length and role mix per session."""
    size = F.length(content)
    return turns.groupBy(session).agg(
        F.count(F.lit(1)).alias("turns"),
        F.count_if(F.col("role") == "user").alias("user_turns"),
        F.count_if(F.col("role") == "assistant").alias("assistant_turns"),
        F.max(size).alias("longest"),
        F.sum(size.cast("bigint")).alias("chars"),
        F.sum(ft.token_estimate(F.col(content))).alias("tokens"),
    )


def lengths_by_day(log: DataFrame) -> DataFrame:
    """Messages, sessions and mean message length per day of the chat log."""
    messages = decoded(log)
    return messages.groupBy(F.date_format("timestamp", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_distinct("session_id").alias("sessions"),
        F.round(F.avg(F.length("content")), 6).alias("mean_chars"),
    )
