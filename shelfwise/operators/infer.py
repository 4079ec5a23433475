"""Batch inference over columns: dedupe, retry, versions, guards and quantisation."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions.vectors import hashed_embedding
from shelfwise.session import fits, spread_join


def batch_infer(
    df: DataFrame, in_col: str, out_col: str, fn: Callable[[Column], Column], spread_by: str
) -> DataFrame:
    """Call `fn` once per distinct value of `in_col` and give every row its answer.

    Copies collapse in the partial aggregate before the shuffle; the value is a grouping key beside its
    hash, so that no sort of all values is needed. The way back spreads the rows of any value that is copied very often.
    """
    hashed = df.withColumn("content_hash", F.md5(in_col))
    distinct = hashed.select("content_hash", in_col).distinct()
    answers = distinct.select("content_hash", fn(F.col(in_col)).alias(out_col))
    return spread_join(hashed, answers, ["content_hash"], [spread_by], "left")


def embed(df: DataFrame, in_col: str, spread_by: str, dim: int = config.EMBEDDING_DIM) -> DataFrame:
    return batch_infer(df, in_col, "embedding_vector", lambda c: hashed_embedding(c, dim), spread_by)


def points_somewhere(vector: str) -> Column:
    """True for a vector a search can take: not missing and not all zeros."""
    return F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def infer_with_retry(
    df: DataFrame, in_col: str, fn: Callable[[str, int], str], max_attempts: int = 3, concurrency: int | None = None,
    backoff: float = 0.0,
) -> DataFrame:
    """Add `answer`, `status`, `attempts` and `error`; a failing row is a row, not a failed job.

    `fn(value, attempt)` may raise. `concurrency` caps how many tasks call the model at once; the
    wait before another attempt starts at `backoff` seconds and doubles. Rows that still fail are
    listed by `requeue` for a later run.
    """

    def call(value: str | None) -> tuple:
        error = None
        for attempt in range(1, max_attempts + 1):
            try:
                return fn(value, attempt), "OK", attempt, None
            except Exception as caught:  # noqa: BLE001 - reported per row
                error = str(caught)
                if backoff and attempt < max_attempts:
                    time.sleep(backoff * 2 ** (attempt - 1))
        return None, "ERROR", max_attempts, error

    @F.pandas_udf("answer string, status string, attempts int, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([call(v) for v in batch], columns=["answer", "status", "attempts", "error"])

    spread = df.repartition(concurrency) if concurrency else df
    return spread.withColumn("_call", run(F.col(in_col))).select(*df.columns, "_call.*")


def requeue(results: DataFrame, key: str) -> DataFrame:
    """Keys that still need an answer."""
    return results.filter("status = 'ERROR'").select(key)


def pending(source: DataFrame, target: DataFrame, on: list[str], spread_by: list[str]) -> DataFrame:
    """Rows of source that target does not have yet; a value copied very often is spread."""
    done = target.select(*on).distinct()
    return spread_join(source, done, on, spread_by, "left_anti", small_fits=fits(done))


def vector_problem(vector: Column, dim: int) -> Column:
    """NULL for a usable vector, else why it is not."""
    norm = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return (
        F.when(vector.isNull(), "missing")
        .when(F.size(vector) != dim, "dimension")
        .when(F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))), "not_a_number")
        .when(norm == 0, "zero_norm")
    )


def dimension_guard(df: DataFrame, vector: str, dim: int) -> tuple[DataFrame, DataFrame]:
    """(vectors that may enter the index, rejected ones with a reason)."""
    tagged = df.withColumn("reject_reason", vector_problem(F.col(vector), dim))
    return (
        tagged.filter("reject_reason IS NULL").drop("reject_reason"),
        tagged.filter("reject_reason IS NOT NULL"),
    )


def embedding_versions(versions: dict[str, DataFrame], key: str, vector: str) -> DataFrame:
    """Long table (key, model_version, vector); versions never share a column."""
    parts = [
        df.select(key, F.lit(name).alias("model_version"), F.col(vector).alias("vector"))
        for name, df in versions.items()
    ]
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    return long


def versions_view(long: DataFrame, key: str, names: list[str]) -> DataFrame:
    """One row per key with one column per model version."""
    return long.groupBy(key).pivot("model_version", names).agg(F.any_value("vector", ignoreNulls=True))


def quantize(df: DataFrame, key: str, vector: str) -> DataFrame:
    """int8 codes (min/max per vector), sign bits packed into one long, and the rounding error."""
    low, high = F.array_min(vector).cast("double"), F.array_max(vector).cast("double")
    bounded = df.select(key, F.col(vector).alias("v"), low.alias("low"), ((high - low) / 255).alias("step"))
    code = F.transform(
        "v", lambda x: F.when(F.col("step") == 0, 0).otherwise(F.floor((x.cast("double") - F.col("low")) / F.col("step") + 0.5)).cast("int")
    )
    bits = F.aggregate(
        "v",
        F.lit(0).cast("bigint"),
        lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(F.when(x > 0, 1).otherwise(0).cast("bigint")),
    )
    coded = bounded.withColumn("codes", code).withColumn("sign_bits", bits)
    errors = F.zip_with("v", "codes", lambda x, c: F.abs(x.cast("double") - (F.col("low") + c * F.col("step"))))
    return coded.withColumn("max_error", F.array_max(errors)).drop("v")
