"""Metrics over predictions, rankings, judges and runs. Inputs are long tables, so every metric is an aggregate."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import text as ft
from shelfwise.operators.infer import infer_with_retry


OVERLAP = ("n_left", "n_right", "shared", "dot", "sq_left", "sq_right")


def _overlaps(left: pa.Array, right: pa.Array) -> list[np.ndarray]:
    """The `OVERLAP` columns of a batch of two lists of grams per row."""
    rows = len(left)
    grams = pa.concat_arrays([left.flatten(), right.flatten()]).dictionary_encode()
    code, width = grams.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(len(grams.dictionary), 1)
    sizes = [pc.fill_null(pc.list_value_length(side), 0).to_numpy(zero_copy_only=False).astype(np.int64) for side in (left, right)]
    split = int(sizes[0].sum())
    row = [np.repeat(np.arange(rows), n) for n in sizes]
    (l_key, l_n), (r_key, r_n) = (
        np.unique(own * width + part, return_counts=True) for own, part in zip(row, (code[:split], code[split:]))
    )
    _, at_left, at_right = np.intersect1d(l_key, r_key, assume_unique=True, return_indices=True)
    both, l_both, r_both = l_key[at_left] // width, l_n[at_left], r_n[at_right]

    def total(key: np.ndarray, value: np.ndarray) -> np.ndarray:
        return np.bincount(key, value, rows).astype(np.int64)

    return [
        *sizes, total(both, np.minimum(l_both, r_both)), total(both, l_both * r_both),
        total(l_key // width, l_n * l_n), total(r_key // width, r_n * r_n),
    ]


def overlap(pairs: DataFrame, key: str, left: str, right: str, n: int = 1) -> DataFrame:
    """Multiset n-gram overlap of two texts per row, computed where the row is: no shuffle.

    Columns: n_left, n_right, shared (sum of the smaller counts), dot, sq_left, sq_right. A NULL
    text is empty; rows of two empty texts come back with zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pa.array(column) for column in _overlaps(batch["l"], batch["r"])]
            yield pa.RecordBatch.from_arrays([batch["key"], *found], names=[key, *OVERLAP])

    grams = [ft.ngrams(ft.tokens(F.col(side)), n).alias(name) for side, name in ((left, "l"), (right, "r"))]
    kind = pairs.schema[key].dataType.simpleString()
    schema = ", ".join([f"`{key}` {kind}", *(f"{name} bigint" for name in OVERLAP)])
    return pairs.select(F.col(key).alias("key"), *grams).mapInArrow(run, schema)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def f1(pairs: DataFrame, key: str, prediction: str, truth: str, n: int = 1) -> DataFrame:
    """Precision, recall and F1 of the overlapping n-grams."""
    found = overlap(pairs, key, prediction, truth, n)
    p, r = _share(F.col("shared"), F.col("n_left")), _share(F.col("shared"), F.col("n_right"))
    return found.select(
        key,
        F.round(p, 6).alias("precision"),
        F.round(r, 6).alias("recall"),
        F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 6).alias("f1"),
    )


def lexical_cosine(pairs: DataFrame, key: str, left: str, right: str) -> DataFrame:
    found = overlap(pairs, key, left, right)
    norm = F.sqrt(F.col("sq_left") * F.col("sq_right"))
    return found.select(key, F.round(_share(F.col("dot"), norm), 6).alias("cosine"))


def exact_match(pairs: DataFrame, prediction: str, truth: str, *by: str) -> DataFrame:
    hit = F.coalesce(F.col(prediction) == F.col(truth), F.lit(False))
    return pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(hit.cast("int")), 6).alias("exact_match"))


def readability(text: Column) -> Column:
    """Flesch-Kincaid grade; a word has one syllable per vowel group and at least one."""
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), ft.TOKEN_SEPARATOR, " "), F.lit(" "))
    words = ft.token_count(text)
    sentences = F.greatest(F.regexp_count(text, F.lit(r"[.!?]+")), F.lit(1))
    vowel_groups = F.regexp_count(spaced, F.lit("[aeiouy]+"))
    silent_words = F.regexp_count(spaced, F.lit("(?<= )[^aeiouy ]+(?= )"))
    grade = 0.39 * words / sentences + 11.8 * (vowel_groups + silent_words) / words - 15.59
    return F.when(words > 0, F.round(grade, 6))


def judge_prompt(ground_truth: Column, prediction: Column) -> Column:
    return ft.fill_template(config.JUDGE_TEMPLATE, ground_truth=ground_truth, prediction=prediction)


def judge_score(reply: Column) -> Column:
    """YES is 1.0, NO is 0.0, anything else has no score."""
    word = F.upper(F.regexp_extract(reply, r"(?i)^\s*(yes|no)\b", 1))
    return F.when(word == "YES", 1.0).when(word == "NO", 0.0)


def lexical_judge(pairs: DataFrame, key: str, prediction: str, truth: str, threshold: float = 0.5) -> DataFrame:
    """Stand-in judge: YES when the token cosine reaches the threshold."""
    scored = lexical_cosine(pairs, key, prediction, truth)
    return scored.withColumn("reply", F.when(F.col("cosine") >= threshold, "YES").otherwise("NO"))


Judge = Callable[[DataFrame, str, str, str], DataFrame]


def model_judge(fn: Callable[[str, int], str], **options) -> Judge:
    """Judge that sends the fixed prompt to a model: `fn(prompt, attempt)` replies in text; failures have no score."""

    def judged(pairs: DataFrame, key: str, prediction: str, truth: str) -> DataFrame:
        prompts = pairs.select(key, judge_prompt(F.coalesce(truth, F.lit("")), F.coalesce(prediction, F.lit(""))).alias("_prompt"))
        return infer_with_retry(prompts, "_prompt", fn, **options).select(key, F.col("answer").alias("reply"))

    return judged


def judge(
    pairs: DataFrame, key: str, prediction: str, targets: dict[str, str], threshold: float = 0.5, by: Judge | None = None
) -> DataFrame:
    """Long table (row, metric, value): one judged metric per target column, by the stand-in or any other judge."""
    out = None
    for metric, column in targets.items():
        replies = by(pairs, key, prediction, column) if by else lexical_judge(pairs, key, prediction, column, threshold)
        rows = replies.select(key, F.lit(metric).alias("metric"), judge_score(F.col("reply")).alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


def metric_means(long: DataFrame) -> DataFrame:
    return long.groupBy("metric").agg(F.count("value").alias("n"), F.round(F.avg("value"), 6).alias("mean"))


def quality_gate(means: DataFrame, threshold: float = config.GATE_THRESHOLD) -> DataFrame:
    """One row per metric with its verdict; a metric without rows fails."""
    return means.withColumn("threshold", F.lit(threshold)).withColumn(
        "passed", F.coalesce(F.col("mean") >= threshold, F.lit(False))
    )


def retrieval_metrics(ranked: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """MRR, recall@k, precision@k and NDCG@k per question.

    `ranked` is (question_id, rank, is_relevant); `relevant` is (question_id, n_relevant) and
    names every question, also those without a single hit.
    """
    gain = F.when(F.col("is_relevant"), 1 / F.log2(F.col("rank") + 1)).otherwise(0.0)
    per_question = ranked.filter(F.col("rank") <= k).groupBy("question_id").agg(
        F.min(F.when(F.col("is_relevant"), F.col("rank"))).alias("first"),
        F.count_if("is_relevant").alias("found"),
        F.sum(gain).alias("dcg"),
    )
    joined = relevant.join(per_question, "question_id", "left")
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.least(F.col("n_relevant"), F.lit(k)), F.lit(1)).cast("int")),
        F.lit(0.0),
        lambda acc, i: acc + 1 / F.log2(i + 1),
    )
    return joined.select(
        "question_id",
        F.round(F.coalesce(1 / F.col("first"), F.lit(0.0)), 6).alias("reciprocal_rank"),
        F.round(F.coalesce(_share(F.col("found"), F.col("n_relevant")), F.lit(0.0)), 6).alias("recall"),
        F.round(F.coalesce(F.col("found") / k, F.lit(0.0)), 6).alias("precision"),
        F.round(F.when(F.col("n_relevant") > 0, F.coalesce("dcg", F.lit(0.0)) / ideal).otherwise(0.0), 6).alias("ndcg"),
    )


def containment(answer: Column, context: Column, n: int = 3) -> Column:
    """Share of the answer's distinct n-grams that the context holds."""
    said = F.array_distinct(ft.ngrams(ft.tokens(answer), n))
    held = F.size(F.array_intersect(said, ft.ngrams(ft.tokens(context), n)))
    return F.when(F.size(said) > 0, F.round(held / F.size(said), 6))


def blame(df: DataFrame, retrieval_ok: str, answer_ok: str) -> DataFrame:
    """How often each part failed: the retriever, the generator, both or none."""
    part = (
        F.when(F.col(retrieval_ok) & F.col(answer_ok), "none")
        .when(F.col(retrieval_ok), "generator")
        .when(F.col(answer_ok), "retriever")
        .otherwise("both")
    )
    return df.groupBy(part.alias("failed_part")).agg(F.count(F.lit(1)).alias("n"))


def agreement(df: DataFrame, judge_col: str, human_col: str) -> DataFrame:
    """Correlation, agreement and Cohen's kappa of two 0/1 columns, from one aggregate; all NULL without rows."""
    j, h = F.col(judge_col), F.col(human_col)
    cells = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((j == 1) & (h == 1)).alias("both_yes"),
        F.count_if((j == 0) & (h == 0)).alias("both_no"),
        F.sum(j.cast("bigint")).alias("judge_yes"),
        F.sum(h.cast("bigint")).alias("human_yes"),
        F.round(F.corr(j.cast("double"), h.cast("double")), 6).alias("correlation"),
    )
    n = F.col("n")
    observed = F.try_divide(F.col("both_yes") + F.col("both_no"), n)
    expected = F.try_divide(F.col("judge_yes") * F.col("human_yes") + (n - F.col("judge_yes")) * (n - F.col("human_yes")), n * n)
    return cells.withColumn("agreement", F.round(observed, 6)).withColumn(
        "kappa", F.when(expected < 1, F.round((observed - expected) / (1 - expected), 6))
    )


def tier(df: DataFrame, key: str, size: int, seed: str = "42") -> DataFrame:
    """The same `size` rows every time: smallest key hashes first."""
    return df.withColumn("_h", ft.hash_int(F.col(key), seed=seed)).orderBy("_h", key).limit(size).drop("_h")


def compare_runs(first: DataFrame, second: DataFrame, key: str, metric: str) -> DataFrame:
    """Wins, losses and ties of the second run, with the mean change."""
    delta = F.col("b") - F.col("a")
    joined = first.select(key, F.col(metric).alias("a")).join(second.select(key, F.col(metric).alias("b")), key)
    outcome = F.when(delta > 0, "win").when(delta < 0, "loss").otherwise("tie")
    return joined.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(delta), 6).alias("mean_delta"))


