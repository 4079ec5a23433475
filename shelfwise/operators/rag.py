"""Answering a table of questions: prompts, citations, stand-in answers, routing, stock replies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import text as ft
from shelfwise.operators import search
from shelfwise.operators.infer import infer_with_retry
from shelfwise.session import fits, spread_join

# Patterns that send a question to each tool.
ROUTES = (
    ("sku_inventory", r"(?i)\bsku-?[0-9]+\b|\bin stock\b"),
    ("warehouse_query", r"(?i)\bhow many\b|\btotal\b|\bcount\b|\brevenue\b|\bsales\b|\bstores?\b"),
    ("document_search", r"(?i)\bpolicy\b|\breturns?\b|\bhandbook\b|\bguidelines?\b|\bwarranty\b|\bmanual\b"),
)
CHAT_PATTERN = r"(?i)^\s*(?:hi|hello|hey|thanks|thank you|good (?:morning|evening))\b"


def rag_prompts(questions: DataFrame, contexts: DataFrame, organization: str = config.ORGANIZATION) -> DataFrame:
    """Prompt and citations per question; a question without hits gets the fixed reply instead."""
    joined = questions.join(contexts.withColumnRenamed("question_id", "id"), "id", "left")
    missing = F.col("context").isNull()
    return joined.select(
        F.col("id").alias("question_id"),
        F.when(~missing, ft.rag_prompt(F.col("context"), F.col("text"), organization)).alias("prompt"),
        F.when(missing, config.NO_CONTEXT_ANSWER).alias("answer"),
        F.coalesce("citations", F.array().cast("array<string>")).alias("citations"),
    )


def model_answers(prompts: DataFrame, fn: Callable[[str, int], str], **options) -> DataFrame:
    """Answers of a model to `rag_prompts`: (question_id, answer, status, attempts, error, citations).

    `fn(prompt, attempt)` may raise; questions without context keep the fixed reply and are not sent.
    """
    asked = prompts.filter("prompt IS NOT NULL").drop("answer")
    replied = infer_with_retry(asked, "prompt", fn, **options)
    fixed = prompts.filter("prompt IS NULL").select(
        "question_id", "answer", F.lit("NO_CONTEXT").alias("status"), F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("error"), "citations"
    )
    return replied.select("question_id", "answer", "status", "attempts", "error", "citations").unionByName(fixed)


def extractive_answers(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """Stand-in generator: the context sentence sharing most distinct tokens with the question."""
    asked = questions.select(F.col("id").alias("question_id"), ft.tokens(F.col("text")).alias("asked"))
    sentences = hits.select(
        "question_id", "rank", F.posexplode(F.split("text", r"(?<=[.!?])\s+")).alias("position", "sentence")
    )
    overlap = F.size(F.array_intersect(ft.tokens(F.col("sentence")), "asked"))
    best = F.min_by("sentence", F.struct(-F.col("overlap"), F.col("rank"), F.col("position")))
    answered = (
        sentences.join(asked, "question_id")
        .withColumn("overlap", overlap)
        .groupBy("question_id")
        .agg(best.alias("answer"), F.max("overlap").alias("overlap"))
    )
    return asked.select("question_id").join(answered, "question_id", "left").select(
        "question_id",
        F.coalesce("answer", F.lit(config.NO_CONTEXT_ANSWER)).alias("answer"),
        F.coalesce("overlap", F.lit(0)).alias("overlap"),
    )


def route_names(text: Column, routes: tuple[tuple[str, str], ...] = ROUTES, chat: str = CHAT_PATTERN, other: str = "document_search") -> Column:
    """Every tool whose pattern matches; small talk goes to chat; anything else to `other`."""
    matched = F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in routes]))
    return F.when(F.size(matched) > 0, matched).when(text.rlike(chat), F.array(F.lit("chat"))).otherwise(F.array(F.lit(other)))


def route_questions(questions: DataFrame, text: str = "text", **rules) -> DataFrame:
    return questions.withColumn("route", F.explode(route_names(F.col(text), **rules)))


def stock_reply(stock: Column) -> Column:
    return (
        F.when(stock.isNull(), config.SKU_MISSING)
        .when(stock == 0, config.SKU_EMPTY)
        .otherwise(F.concat(stock.cast("string"), F.lit(config.SKU_COUNT_SUFFIX)))
    )


def check_inventory(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """Reply per requested `sku`: a size-checked broadcast lookup, else a join with hot SKUs spread."""
    stock = inventory.select("sku", "stock")
    spread_by = [c for c in requests.columns if c != "sku"] or ["sku"]
    found = spread_join(requests, stock, ["sku"], spread_by, "left", small_fits=fits(stock))
    return found.withColumn("reply", stock_reply(F.col("stock")))


class ViewRegistry:
    """Read access to listed views only; a result that is not aggregated is capped."""

    def __init__(self, views: dict[str, DataFrame], cap: int = config.DEFAULT_ROW_CAP):
        self.views, self.cap = views, cap

    def run(self, name: str, build, order_by: tuple[str, ...] = (), aggregated: bool = False) -> DataFrame:
        if name not in self.views:
            raise PermissionError(f"view {name} is not listed")
        result = build(self.views[name])
        return result if aggregated else result.orderBy(*order_by).limit(self.cap)


def answer_context(questions: DataFrame, corpus: DataFrame, k: int = config.RAG_TOP_K) -> tuple[DataFrame, DataFrame]:
    """(hits with text, contexts with citations) by keyword search over `id, text, source`."""
    hits = search.bm25(questions.select("id", "text"), corpus.select("id", "text"), k)
    shown = search.attach_text(hits, corpus, "id", "text", "source", few=search.fits(questions, search.QUESTION_BYTES // 1024))
    return shown, search.format_context(shown)




def pack_context(hits: DataFrame, budget: int = config.CONTEXT_BUDGET, per_hit: int = 0) -> DataFrame:
    """Hits with the tokens each adds to its question's context, the running total, and whether it still fits.

    `hits` has question_id, rank, and source, ordinal, start and text of a chunk. Text a chunk shares with a neighbour of
    its document that ranks higher counts once. Hits are taken in rank order until one does not fit; it and all below
    it are listed with `packed` false. A token is four characters; `per_hit` are added for the frame around each.
    """
    beside = Window.partitionBy("question_id", "source").orderBy("ordinal")
    end = F.col("start") + F.length("text")

    def shared(step: int):
        """Characters in common with the neighbour before (-1) or after (1), if that ranks higher."""
        near = F.lag if step < 0 else F.lead
        ours = near(end, 1).over(beside) - F.col("start") if step < 0 else end - near("start", 1).over(beside)
        higher = (near("rank", 1).over(beside) < F.col("rank")) & (near("ordinal", 1).over(beside) == F.col("ordinal") + step)
        return F.when(higher, F.greatest(ours, F.lit(0))).otherwise(0)

    added = F.greatest(F.length("text") - F.coalesce(shared(-1), F.lit(0)) - F.coalesce(shared(1), F.lit(0)), F.lit(0))
    counted = hits.withColumn("tokens", (F.ceil(added / 4) + per_hit).cast("bigint"))
    in_order = Window.partitionBy("question_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.withColumn("total", F.sum("tokens").over(in_order))
    return summed.withColumn("packed", F.col("total") <= budget)
