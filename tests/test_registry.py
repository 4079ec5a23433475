"""Registered queries against their SQL on the smallest tables, and the plans that matter at scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
QUERIES = {key: query for module in entry.MODULES for key, query in module.QUERIES.items()}
ORACLE = {key: sql for module in entry.MODULES for key, sql in module.ORACLE.items()}
ROWS_ONLY = {"chunk_recursive_raw", "ann_ivf", "ann_lsh", "ann_report"}
# A sample by module; SHELFWISE_ALL=1 runs every key.
QUICK = (
    "ingest_files_stream change_feed index_sync seed_tables extract_text strip_boilerplate_lines chunk_recursive "
    "chunk_heading chunk_parent_child batch_embed quantize_vectors knn_exact knn_block_join bm25_search bm25_join "
    "semantic_cache batch_rag_prompts rag_no_context batch_answer stock_decision top_products_region memory_clear "
    "history_prompt guard_verdict redact_pii eval_rouge_n retrieval_metrics faithfulness trace_rollup nightly_judge "
    "question_drift quality_trend monitor_stream"
).split()


def test_every_query_is_checked():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY


@pytest.mark.parametrize("key", sorted(ORACLE) if os.getenv("SHELFWISE_ALL") else QUICK)
def test_matches_sql(spark, key):
    df = QUERIES[key](spark, SF)
    cursor = check.duck(SF).execute(ORACLE[key])
    names = [d[0] for d in cursor.description]
    assert check.compare(df.columns, [tuple(r) for r in df.collect()], names, cursor.fetchall()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_filter_reaches_the_scan(spark):
    text = plan(QUERIES["top_stores_month"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "TakeOrderedAndProject" in text


def test_partition_filter_prunes(spark):
    text = plan(QUERIES["partitioned_log_scan"](spark, SF))
    assert "PartitionFilters: [isnotnull(date_utc" in text


def test_vector_scan_is_pruned_before_the_shuffle(spark):
    text = plan(QUERIES["knn_exact"](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("key", ["bm25_search", "bm25_join", "knn_block_join", "hybrid_search", "batch_rag_prompts"])
def test_no_cross_joins(spark, key):
    text = plan(QUERIES[key](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
