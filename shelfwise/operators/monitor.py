"""Traces, inference logs, feedback and drift."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import text as ft
from shelfwise.session import fits

MESSAGES = "struct<messages:array<struct<role:string,content:string>>,response:string>"

# Words too common to be a topic, for the four languages of the logs.
STOP_WORDS = (
    "a an and are as at be by de der des die do el en es et for from in is it la las le les los of on or "
    "para por que se the this that to un una une und was with zu von mit ein eine ist das nicht"
).split()


def spans(events: DataFrame, trace: Column, name: str, latency: str, failed: Column, attributes: Column) -> DataFrame:
    """Logged events as span rows with status and, on failure, a message."""
    return events.select(
        "event_id",
        trace.alias("trace_id"),
        F.col(name).alias("name"),
        F.col("ts").alias("ts"),
        F.col(latency).alias("latency"),
        F.when(failed, "ERROR").otherwise("OK").alias("status"),
        F.when(failed, F.concat(F.col(name), F.lit(" failed"))).alias("error_message"),
        attributes.alias("attributes"),
    )


def trace_rollup(span_rows: DataFrame) -> DataFrame:
    """Latency, errors, token cost and slowest child per trace; all partial aggregates."""
    tokens = F.col("attributes")["tokens"].try_cast("bigint")
    slowest = F.max_by("name", F.struct(F.col("latency"), -F.col("event_id")))
    return span_rows.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("spans"),
        F.sum(F.col("latency").cast("decimal(18,2)")).alias("latency"),
        F.count_if(F.col("status") == "ERROR").alias("errors"),
        F.sum(tokens).alias("tokens"),
        F.round(F.sum(tokens) * config.PRICE_IN_PER_MILLION / 1e6, 9).alias("cost_usd"),
        slowest.alias("slowest"),
    )


def trace_filter(span_rows: DataFrame, status: str, **attributes: str) -> DataFrame:
    """Traces holding a span with this status and these attributes."""
    wanted = span_rows.filter(F.col("status") == status)
    for name, value in attributes.items():
        wanted = wanted.filter(F.col("attributes")[name] == value)
    return wanted


def trace_sample(span_rows: DataFrame, key: str, one_in: int = 10) -> DataFrame:
    """Every error and one success in `one_in`, the same ones every time."""
    return span_rows.filter((F.col("status") == "ERROR") | (ft.hash_int(F.col(key)) % one_in == 0))


def day_range(column: str, day: date) -> Column:
    """Half-open range on the bare column, so partitions and row groups can be skipped."""
    start = F.lit(day.isoformat()).cast("timestamp")
    return (F.col(column) >= start) & (F.col(column) < F.lit((day + timedelta(days=1)).isoformat()).cast("timestamp"))


def logs_yesterday(log: DataFrame, as_of: date, cap: int | None = None) -> DataFrame:
    """Requests of the day before `as_of`; with a cap, the oldest of them in order, for a report."""
    rows = log.filter(day_range("timestamp", as_of - timedelta(days=1))).select(
        F.col("request_metadata.client_request_id").alias("request_id"), "request_payload", "response_payload", "timestamp"
    )
    return rows.orderBy("timestamp", "request_id").limit(cap) if cap else rows


def parse_payloads(log: DataFrame) -> DataFrame:
    """Question and answer text out of either payload shape; unreadable JSON gives NULL."""
    asked = F.from_json("request_payload", MESSAGES)["messages"]
    answered = F.from_json("response_payload", MESSAGES)
    return log.withColumn("question", F.try_element_at(asked, F.lit(-1))["content"]).withColumn(
        "answer", F.coalesce(answered["response"], F.try_element_at(answered["messages"], F.lit(-1))["content"])
    )


def sample_n(df: DataFrame, key: str, n: int, seed: str = "42") -> DataFrame:
    """n rows, the same ones every time."""
    return df.withColumn("_h", ft.hash_int(F.col(key), seed=seed)).orderBy("_h", key).limit(n).drop("_h")


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: str = "42") -> DataFrame:
    """About `fraction` of the rows, decided per row without a shuffle."""
    return df.filter(ft.hash_int(F.col(key), seed=seed) < F.lit(int(fraction * 2**32)))


def feedback_join(requests: DataFrame, feedback: DataFrame) -> DataFrame:
    """Votes per request; feedback is counted per request before it meets the log."""
    votes = feedback.groupBy("request_id").agg(
        F.count_if(F.col("vote") == "up").alias("up"), F.count_if(F.col("vote") == "down").alias("down")
    )
    joined = requests.join(votes, "request_id", "left").na.fill(0, ["up", "down"])
    total = F.col("up") + F.col("down")
    return joined.withColumn("down_rate", F.when(total > 0, F.round(F.col("down") / total, 6)))


def failing_conversations(requests: DataFrame, feedback: DataFrame, conversation: str, least_rate: float = 0.5) -> DataFrame:
    """Conversations whose requests got votes: requests, votes, share of votes down, and whether that reaches `least_rate`.

    Votes are counted per request and requests per conversation, each combined before its shuffle.
    """
    votes = feedback_join(requests, feedback)
    summed = votes.groupBy(conversation).agg(F.count(F.lit(1)).alias("requests"), F.sum("up").alias("up"), F.sum("down").alias("down"))
    rate = F.round(F.col("down") / (F.col("up") + F.col("down")), 6)
    return summed.filter("up + down > 0").withColumn("down_rate", rate).withColumn("failing", F.col("down_rate") >= least_rate)


def topic_words(questions: DataFrame, day: str, text: str) -> DataFrame:
    """(day, topic): every word asked that is no stop word."""
    words = questions.select(day, F.explode(ft.tokens(F.col(text))).alias("topic"))
    return words.filter(~F.col("topic").isin(*STOP_WORDS))


def topics(questions: DataFrame, day: str, text: str, k: int = 10) -> DataFrame:
    """Most common words per day; words are counted before they are ranked."""
    counted = topic_words(questions, day, text).groupBy(day, "topic").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy(day).orderBy(F.desc("n"), "topic")
    return counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def quality_trend(events: DataFrame, series: str, timestamp: str, value: str, drift: float = 0.05) -> DataFrame:
    """Daily mean per series, change to the previous day, 7-day mean, drift flag."""
    daily = events.groupBy(series, F.to_date(timestamp).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total")
    )
    mean = F.col("total").cast("double") / F.col("n")
    order = W.partitionBy(series).orderBy("day")
    week = order.rowsBetween(-6, 0)
    rolling = F.sum("total").over(week).cast("double") / F.sum("n").over(week)
    return (
        daily.withColumn("mean", mean)
        .withColumn("change", F.round(F.col("mean") - F.lag("mean").over(order), 6))
        .withColumn("rolling", F.round(rolling, 6))
        .withColumn("drifted", F.abs(F.col("mean") - rolling) > drift * F.abs(rolling))
        .withColumn("mean", F.round("mean", 6))
        .drop("total")
    )


def golden_candidates(failed: DataFrame, golden: DataFrame, question: str, golden_text: str) -> DataFrame:
    """Questions of failed requests that are not golden yet, one row per distinct text."""
    known = golden.select(F.md5(golden_text).alias("content_hash"))
    asked = failed.groupBy(F.md5(question).alias("content_hash")).agg(
        F.min("request_id").alias("request_id"), F.count(F.lit(1)).alias("times")
    )
    return asked.join(known, "content_hash", "left_anti")


def question_drift(questions: DataFrame, corpus_text: DataFrame, day: str, text: str, corpus_col: str) -> DataFrame:
    """Share of asked words per day that no document contains.

    Only words somebody asked for are kept from the corpus, so its vocabulary is never built.
    """
    asked = questions.select(day, F.explode(ft.tokens(F.col(text))).alias("term")).groupBy(day, "term").agg(
        F.count(F.lit(1)).alias("n")
    )
    vocabulary = asked.select("term").distinct()
    words = corpus_text.select(F.explode(F.array_distinct(ft.tokens(F.col(corpus_col)))).alias("term"))
    # One row per word and task, or per word, reaches the join: no word is a hot key.
    if fits(vocabulary):
        known = words.join(F.broadcast(vocabulary), "term", "left_semi").distinct()
    else:
        known = words.distinct().join(vocabulary, "term", "left_semi")
    marked = asked.join(known.withColumn("known", F.lit(1)), "term", "left")
    new = F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0))
    return marked.groupBy(day).agg(
        F.sum("n").alias("words"), new.alias("new_words"), F.round(new / F.sum("n"), 6).alias("new_share")
    )


def retention(events: DataFrame, user: str, timestamp: str, days: int = 30) -> DataFrame:
    """Per first-seen day: users, and how many came back within `days`.

    Activity is reduced to distinct (user, day) first, so a very active user is a few rows.
    """
    active = events.groupBy(user, F.to_date(timestamp).alias("day")).agg(F.lit(1).alias("_"))
    first = active.groupBy(user).agg(F.min("day").alias("cohort"))
    back = active.join(first, user).filter(
        (F.col("day") > F.col("cohort")) & (F.col("day") <= F.date_add("cohort", days))
    )
    returned = back.select(user).distinct().withColumn("returned", F.lit(1))
    return (
        first.join(returned, user, "left")
        .groupBy("cohort")
        .agg(F.count(F.lit(1)).alias("users"), F.count("returned").alias("returned"))
        .withColumn("retention", F.round(F.col("returned") / F.col("users"), 6))
    )
