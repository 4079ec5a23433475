"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

`fill` shares a total among sources by weight. A source stops at `max_epochs` times its size; what it cannot
take is shared again among the others by weight, until none is above its cap. Every round is one aggregate
over the table of sources; only its two sums reach the driver.

`mix_plan` turns targets into repetitions: every document `whole` times, and once more the documents up to
a cut in a seeded order (md5 of seed and id), so that a source misses its target by half a document at most.
The plan has one row per source. `apply_plan` decides for each document from its own row and its source's:
no text is shuffled. Running totals are dealt by ranges of the seeded order, so a source with a third of
all rows is spread like the others.

Defined results: a null text has size 0; null is a source of its own, the last one; rows with equal id, size and
source are taken or left together; a source without words has target 0 and is not taken; a target total
beyond all caps takes every source at its cap; an empty table gives an empty plan; other columns pass
through, names that start with `_mix` apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.ordering import ranked, running_total
from shelfwise.session import fits, materialize
from shelfwise.sources.tables import table

EPOCHS = 1.5
MAX_EPOCHS = 2
SEED = 20
WEIGHTS = (3, 1, 2)


def text_size(text: str = "text") -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def seeded_key(id_col: str, size: Column, seed: int) -> Column:
    """Position of a document in the seeded order of its source."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col)).cast("binary"))
    return F.concat_ws("-", digest, F.lpad(size.cast("string"), 12, "0"))


def fill(sources: DataFrame, total: float, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """`sources` (source, source_size, weight) with `target`: shares of `total` by weight, capped."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    weight = F.col("weight").cast("double")
    whole = sources.agg(F.sum(weight).alias("w")).first()
    capped_size, free_weight = 0.0, whole.w or 0.0
    while True:
        above = weight * F.lit(total - capped_size) > cap * F.lit(free_weight)
        sums = sources.agg(F.sum(F.when(above, cap)).alias("c"), F.sum(F.when(~above, weight)).alias("w")).first()
        now = (sums.c or 0.0, sums.w or 0.0)
        if now == (capped_size, free_weight):
            break
        capped_size, free_weight = now
        if not free_weight:
            return sources.withColumn("target", cap)
    if not free_weight:
        return sources.withColumn("target", cap)
    share = weight * F.lit(total - capped_size) / F.lit(free_weight)
    return sources.withColumn("target", F.when(above, cap).otherwise(share))


def cycle_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Weights repeat over the sources in code-point order, null last."""
    order = ranked(sources, [F.col("source").asc_nulls_last()], "_mix_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_mix_rank") % len(weights) + 1).cast("int"))
    return order.withColumn("weight", weight).drop("_mix_rank")


def sized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(id, source, size, key) of every document, written once: all later steps read only this."""
    narrow = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), text_size(text_col).alias("size")
    )
    return materialize(narrow.withColumn("key", seeded_key("id", F.col("size"), seed)), "sizes")


def mix_plan(sizes: DataFrame, epochs: float = EPOCHS, max_epochs: float = MAX_EPOCHS, weights: DataFrame | None = None) -> DataFrame:
    """One row per source: source_size, weight, target, whole repetitions, and the cut of the last, partial one.

    `weights` (source, weight) replaces the repeating ones.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        sources = cycle_weights(sources)
    else:
        named = weights.select(F.col("source").alias("_mix_source"), "weight")
        sources = sources.join(named, F.col("source").eqNullSafe(F.col("_mix_source"))).drop("_mix_source")
    sources = materialize(sources, "sources")
    total = epochs * (sources.agg(F.sum("source_size").alias("n")).first().n or 0)
    targets = fill(sources, total, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    targets = targets.withColumn("whole", whole)
    targets = targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = materialize(running_total(targets, [F.col("source").asc_nulls_last()], "source_size", "start"), "targets")
    # Equal keys of a source are one entry; entries in order of source and key, cut where half an entry passes the rest.
    entries = sizes.groupBy("source", "key").agg(F.sum("size").alias("n"))
    entries = running_total(entries, [F.col("source").asc_nulls_last(), F.col("key").asc()], "n")
    before = F.col("before") - F.col("start")
    cuts = (
        with_plan(entries, targets.select("source", "start", "rest"))
        .filter((2 * before + F.col("n") <= 2 * F.col("rest")) & (F.col("n") > 0))
        .groupBy("source")
        .agg(F.max("key").alias("cut"))
    )
    cut = cuts.select(F.col("source").alias("_mix_source"), "cut")
    return targets.join(cut, F.col("source").eqNullSafe(F.col("_mix_source")), "left").select(
        "source", "source_size", "weight", "target", "whole", "cut"
    )


def with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the columns of their source's plan; a plan that passes the size check is broadcast."""
    named = plan.withColumnRenamed("source", "_mix_source")
    named = F.broadcast(named) if fits(plan) else named
    return rows.join(named, rows["source"].eqNullSafe(F.col("_mix_source"))).drop("_mix_source")


def copies() -> Column:
    """Repetitions of a document with the columns `key`, `whole` and `cut`."""
    return F.col("whole") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", epochs: float = EPOCHS,
        max_epochs: float = MAX_EPOCHS, weights: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document as often as the plan says, all columns as they are."""
    plan = materialize(mix_plan(sized(docs, id_col, source_col, text_col, seed), epochs, max_epochs, weights), "plan")
    plan = plan.select(*[F.col(c).alias(f"_mix_{c}") for c in ("source", "whole", "cut")])
    plan = F.broadcast(plan) if fits(plan) else plan
    key = seeded_key(id_col, text_size(text_col), seed)
    times = F.col("_mix_whole") + F.when(key <= F.col("_mix_cut"), 1).otherwise(0)
    joined = docs.join(plan, docs[source_col].cast("string").eqNullSafe(F.col("_mix_source")))
    repeated = joined.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(0), times)))
    return repeated.select(*[docs[c] for c in docs.columns])


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = sized(table(spark, sf_dir, "documents"))
    plan = materialize(mix_plan(sizes), "plan")
    return with_plan(sizes, plan).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * copies()).cast("bigint").alias("taken"),
        copies().alias("copies"),
    )


QUERIES = {"op8_mix_sources": op8_mix_sources}
ORACLE = {
    "op8_mix_sources": rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws(':', '{SEED}', doc_id::VARCHAR)) AS u FROM documents),
k AS (SELECT *, u || '-' || lpad(size::VARCHAR, 12, '0') AS key FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight
  FROM k GROUP BY source),
o AS (
  SELECT *, {MAX_EPOCHS}.0::DOUBLE * source_size AS cap, {EPOCHS}::DOUBLE * sum(source_size) OVER () AS total,
         coalesce(sum({MAX_EPOCHS}.0::DOUBLE * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (ORDER BY source_size / weight DESC, source DESC NULLS FIRST) AS free,
         row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place
  FROM s),
f AS (SELECT capped, free, place FROM o WHERE weight * (total - capped) <= cap * free ORDER BY place LIMIT 1),
t AS (
  SELECT o.source, o.source_size, CASE WHEN o.place < f.place THEN o.cap ELSE o.weight * (o.total - f.capped) / f.free END AS target
  FROM o, f),
w AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INTEGER ELSE 0 END AS whole FROM t),
e AS (
  SELECT source, key, sum(size) AS n,
         coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k GROUP BY source, key),
c AS (
  SELECT e.source, max(key) AS cut FROM e JOIN w ON e.source IS NOT DISTINCT FROM w.source
  WHERE n > 0 AND 2 * before + n <= 2 * (target - whole * source_size) GROUP BY e.source)
SELECT doc_id, size, w.source_size, target, (size * (whole + CASE WHEN key <= cut THEN 1 ELSE 0 END))::BIGINT AS taken,
       (whole + CASE WHEN key <= cut THEN 1 ELSE 0 END)::INTEGER AS copies
FROM k JOIN w ON k.source IS NOT DISTINCT FROM w.source LEFT JOIN c ON k.source IS NOT DISTINCT FROM c.source
"""
}
