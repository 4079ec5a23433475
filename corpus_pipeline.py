"""From raw documents to shards of a training corpus: five stages, each on all that the one before kept.

1. quality: documents the classifier rejects go (learned from the labels outside the held-out fold).
2. neardup: one document of each group of copies and near copies stays.
3. decontaminate: documents that hold a benchmark window go.
4. mix: documents are repeated or left out until the sources have their target shares.
5. shard: documents get a shard along a Hilbert curve and lie in curve order.

Every stage takes (spark, docs, sf_dir) and returns the columns of the documents; the last adds `shard` and
`curve`. Nulls, empty texts, repeated rows and empty tables have the results the operators' modules state;
documents may have other columns, which all stages keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontaminate, mixing, neardup, quality, sharding
from shelfwise.llm.folds import fold
from shelfwise.session import materialize, prepare
from shelfwise.sources.tables import table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id") != 0)
    return quality.keep_good(docs, model)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return neardup.drop_near_duplicates(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("neardup", keep_distinct),
    ("decontaminate", keep_uncontaminated),
    ("mix", mix_sources),
    ("shard", shard),
]
# The classifier and the MinHash signatures have no SQL; the tests compare the pipeline with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
