"""Batch readers of the given tables, and the reference-shaped views derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def silver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` in the silver layout, with every filterable column kept."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("doc/"), F.col("doc_id")).alias("path"),
        F.col("source").alias("source_system"),
        F.col("lang").alias("region"),
        F.col("text").alias("extracted_text"),
    )


def inference_log(conversations: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it, as one logged request.

    Requests spread over the hours of January 2024. Odd conversations log the short `{"response": ...}` payload, even ones the messages payload.
    """
    asked = conversations.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("q"))
    replied = conversations.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a")
    )

    def messages(role: str, content: str):
        message = F.struct(F.lit(role).alias("role"), F.col(content).alias("content"))
        return F.to_json(F.struct(F.array(message).alias("messages")))

    return asked.join(replied, ["conv_id", "turn"]).select(
        F.struct(F.concat_ws("-", "conv_id", "turn").alias("client_request_id")).alias("request_metadata"),
        messages("user", "q").alias("request_payload"),
        F.when(F.col("conv_id") % 2 == 0, messages("assistant", "a"))
        .otherwise(F.to_json(F.struct(F.col("a").alias("response"))))
        .alias("response_payload"),
        F.timestamp_add("HOUR", F.col("conv_id") * 7 % 720, F.lit("2024-01-01").cast("timestamp")).alias("timestamp"),
    )
