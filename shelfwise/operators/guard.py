"""Safety verdicts, gates, redaction and licence tracking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import text as ft

# The stand-in classifier's attack patterns.
ATTACK_PATTERNS = (
    r"(?i)\bignore\b.{0,40}\binstructions?\b",
    r"(?i)\bsystem prompt\b",
    r"(?i)\bjailbreak\b",
    r"(?i)\b(?:drop|truncate|alter)\s+(?:table|database|schema)\b",
    r"(?i)\bdelete\s+from\b",
    r"(?i)\bhack(?:ing)?\b",
)

# Licence names and the line that grants each.
LICENSES = (
    ("Apache-2.0", r"Apache License, Version 2\.0"),
    ("MIT", r"MIT License"),
    ("GPL-3.0", r"GNU General Public License, version 3"),
    ("CC-BY-NC-4.0", r"CC BY-NC 4\.0"),
)
NON_COMMERCIAL = ("CC-BY-NC-4.0",)


def guard_prompt(message: Column) -> Column:
    return ft.fill_template(config.GUARD_TEMPLATE, message=message)


def rule_reply(message: Column) -> Column:
    """Stand-in guard model: `unsafe` when an attack pattern occurs."""
    hit = F.lit(False)
    for pattern in ATTACK_PATTERNS:
        hit = hit | message.rlike(pattern)
    return F.when(hit, "unsafe").otherwise("safe")


def is_safe(reply: Column, fail_open: bool = True) -> Column:
    """Verdict of a guard reply; a missing reply (failed call) is safe unless closed."""
    return F.coalesce(~F.lower(F.trim(reply)).contains("unsafe"), F.lit(fail_open))


def verdict_status(reply: Column) -> Column:
    return F.when(reply.isNull(), "guard_failed").otherwise("checked")


def gate(df: DataFrame, safe: str, answer: Column) -> DataFrame:
    """The answer where safe, the fixed refusal elsewhere."""
    return df.withColumn("reply", F.when(F.col(safe), answer).otherwise(config.BLOCKED_ANSWER))


def redact(df: DataFrame, column: str) -> DataFrame:
    """Masked text and how many values of each class were masked.

    Classes are masked in a fixed order, each count seen on the text the earlier ones left. One
    cheap test first finds the rows that can hold any class; the others skip every pattern.
    """
    out = df.withColumn("redacted", F.col(column)).withColumn("_maybe", F.col(column).rlike(ft.PII_HINT))
    for name, pattern, mask in ft.PII_PATTERNS:
        count = F.regexp_count("redacted", F.lit(pattern))
        out = out.withColumn(f"n_{name}", F.when(F.col("_maybe"), count).otherwise(F.when(F.col("redacted").isNotNull(), 0)))
        masked = F.regexp_replace("redacted", pattern, mask)
        out = out.withColumn("redacted", F.when(F.col("_maybe"), masked).otherwise(F.col("redacted")))
    return out.drop("_maybe")


def license_of(text: Column) -> Column:
    tag = F.lit(None).cast("string")
    for name, pattern in reversed(LICENSES):
        tag = F.when(text.rlike(pattern), name).otherwise(tag)
    return F.coalesce(tag, F.lit("unknown"))


def license_audit(documents: DataFrame, derived: DataFrame, key: str, text: str) -> DataFrame:
    """Licence per document carried to rows derived from it, with the commercial-use flag.

    The licence is read once per document; `derived` only needs the lineage key.
    """
    tags = documents.select(key, license_of(F.col(text)).alias("license"))
    per_document = derived.groupBy(key).agg(F.count(F.lit(1)).alias("derived_rows"))
    return (
        tags.join(per_document, key, "left")
        .groupBy("license")
        .agg(F.count(F.lit(1)).alias("documents"), F.sum(F.coalesce("derived_rows", F.lit(0))).alias("derived_rows"))
        .withColumn("commercial_use", ~F.col("license").isin(*NON_COMMERCIAL))
    )


def confusion(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Counts and rates of a boolean prediction against a boolean truth, in one aggregate; rates of nothing are NULL."""
    p, a = F.col(predicted), F.col(actual)
    counts = df.agg(
        F.count_if(p & a).alias("true_positive"),
        F.count_if(p & ~a).alias("false_positive"),
        F.count_if(~p & a).alias("false_negative"),
        F.count_if(~p & ~a).alias("true_negative"),
    )

    def rate(hit: str, *rest: str) -> Column:
        total = F.col(hit)
        for other in rest:
            total = total + F.col(other)
        return F.when(total > 0, F.round(F.col(hit) / total, 6))

    return counts.withColumns(
        {
            "false_positive_rate": rate("false_positive", "true_negative"),
            "false_negative_rate": rate("false_negative", "true_positive"),
            "block_rate": F.round(
                F.try_divide(
                    F.col("true_positive") + F.col("false_positive"),
                    F.col("true_positive") + F.col("false_positive") + F.col("false_negative") + F.col("true_negative"),
                ),
                6,
            ),
        }
    )
