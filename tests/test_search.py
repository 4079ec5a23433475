"""Retrieval against brute force on small fixtures."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import vectors as kernel
from shelfwise.operators import infer, rag, search

WORDS = "store return policy receipt blender warranty part espresso machine refund the of and".split()


def vectors(spark, n=120, dim=8, copies=40):
    rng = np.random.default_rng(1)
    rows = rng.standard_normal((n, dim)).astype(np.float32)
    rows[:copies] = rows[0]  # a third of the rows are copies of one
    data = [(i, [float(x) for x in row], i % 3) for i, row in enumerate(rows)]
    return rows, spark.createDataFrame(data, "id long, vector array<float>, tenant int").repartition(5)


def brute(rows, k, allowed=lambda q, i: q != i):
    unit = rows.astype(np.float64)
    unit /= np.sqrt(np.square(unit).sum(axis=1, keepdims=True))
    scores = np.round(unit @ unit.T, 6)
    out = {}
    for q in range(len(rows)):
        ranked = sorted((i for i in range(len(rows)) if allowed(q, i)), key=lambda i: (-scores[q, i], i))
        out[q] = ranked[:k]
    return out


def listed(df):
    out = {}
    for r in df.orderBy("question_id", "rank").collect():
        out.setdefault(r.question_id, []).append(r.id)
    return out


@pytest.mark.parametrize("question_bytes", [search.QUESTION_BYTES, 0])
def test_knn_exact_with_copies(spark, question_bytes):
    rows, df = vectors(spark)
    got = listed(search.knn(df.select("id", "vector"), df.select("id", "vector"), 4, True, question_bytes, dim=8))
    assert got == brute(rows, 4)


@pytest.mark.parametrize("question_bytes", [search.QUESTION_BYTES, 0])
def test_tenants_never_meet(spark, question_bytes):
    rows, df = vectors(spark)
    got = listed(search.knn_for_tenant(df, df, "tenant", k=4, skip_same=True, question_bytes=question_bytes, dim=8))
    assert got == brute(rows, 4, lambda q, i: q != i and q % 3 == i % 3)
    with pytest.raises(PermissionError):
        search.knn_for_tenant(df, df, None)
    with pytest.raises(PermissionError):
        search.knn_for_tenant(df, df.drop("tenant"), "tenant")


def test_filter_runs_before_ranking(spark):
    rows, df = vectors(spark)
    got = listed(search.knn_filtered(df, df, {"tenant": 1}, k=4, skip_same=True, dim=8))
    assert got == brute(rows, 4, lambda q, i: q != i and i % 3 == 1)


def test_recall_of_cells(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 16)) * 3
    rows = (centres[rng.integers(0, 6, 300)] + rng.standard_normal((300, 16)) * 0.5).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "id long, vector array<float>")
    exact = brute(rows, 5)
    got = listed(search.knn_ivf(df, df, cells=6, probes=2, k=5, skip_same=True, dim=16))
    assert np.mean([len(set(exact[q]) & set(got.get(q, []))) / 5 for q in exact]) >= 0.9


def corpus(spark):
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(rng.choice(WORDS, rng.integers(1, 30)))) for i in range(90)]
    docs += [(90 + i, "the return policy of the store") for i in range(45)] + [(200, ""), (201, None)]
    asked = [(i, " ".join(rng.choice(WORDS, 4)) + "?") for i in range(12)] + [(50, "unknownword"), (51, "")]
    schema = "id long, text string"
    return docs, asked, spark.createDataFrame(docs, schema).repartition(4), spark.createDataFrame(asked, schema)


def brute_bm25(docs, asked, k):
    bags = {i: Counter((t or "").replace("?", "").split()) for i, t in docs}
    n, avg = len(docs), sum(sum(b.values()) for b in bags.values()) / len(docs)
    df = Counter(w for b in bags.values() for w in b)
    out = {}
    for q, text in asked:
        scored = []
        for i, bag in bags.items():
            shared = [w for w in set(text.replace("?", "").split()) if w in bag]
            if shared:
                size = sum(bag.values())
                total = sum(
                    math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * 2.2 / (bag[w] + 1.2 * (0.25 + 0.75 * size / avg))
                    for w in shared
                )
                scored.append((-round(total, 6), i))
        if scored:
            out[q] = [i for _, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("question_terms", [500_000, 0])
def test_bm25(spark, question_terms):
    docs, asked, corpus_df, asked_df = corpus(spark)
    got = listed(search.bm25(asked_df, corpus_df, 5, question_terms=question_terms))
    assert got == brute_bm25(docs, asked, 5)


def test_bm25_sparse_route_agrees(spark, monkeypatch):
    import pyarrow as pa

    from shelfwise.functions import keywords

    vocabulary = pa.array(["a", "b", "c"])
    asked = pa.table({"question_id": [1, 1, 2, 3], "term": ["a", "b", "b", "c"]})
    terms = keywords.QuestionTerms.build(asked, vocabulary, np.array([2.0, 3.0, 1.0]), 4, 2.5, 1.2, 0.75)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([10, 11, 12, 13]), pa.array([["a", "b", "b"], ["b", "x"], [], ["a", "b", "c", "c", "x"]])], names=["id", "tokens"]
    )
    results = []
    for dense, matches in ((10**6, 10**6), (0, 10**6), (0, 1), (10**6, 1)):
        monkeypatch.setattr(keywords, "DENSE_CELLS", dense)
        monkeypatch.setattr(keywords, "MATCHES_AT_ONCE", matches)
        best = keywords.KeywordK(terms, 2)
        best.add(batch)
        table = best.batch(pa.int64(), pa.int64()).to_pylist()
        results.append(sorted((r["question_id"], r["id"], r["score"]) for r in table))
    assert results[0] and all(r == results[0] for r in results)


def test_context_prompt_citations(spark):
    corpus_df = spark.createDataFrame(
        [(1, "alpha beta", "a.pdf"), (2, "alpha", "a.pdf"), (3, "alpha beta gamma", "b.pdf"), (4, "delta", "c.pdf")],
        "id long, text string, source string",
    )
    asked = spark.createDataFrame([(1, "alpha beta gamma"), (2, "omega")], "id long, text string")
    hits, contexts = rag.answer_context(asked, corpus_df)
    first = contexts.filter("question_id = 1").first()
    ranked = [(r.text, r.source) for r in hits.filter("question_id = 1").orderBy("rank").collect()]
    want = "".join(f"\n--- Document {i} ---\nSource: {s}\nContent: {t}\n" for i, (t, s) in enumerate(ranked, 1))
    assert first.context == want
    assert first.citations == list(dict.fromkeys(s for _, s in ranked))
    answers = {r.question_id: r for r in rag.rag_prompts(asked, contexts).collect()}
    assert answers[2].answer == "I could not find any relevant documents in the system."
    assert answers[2].citations == [] and answers[2].prompt is None
    assert answers[1].answer is None and want in answers[1].prompt


def test_routing_scenarios(spark):
    asked = [
        "What is the company policy for handling returns without a receipt?",
        "How many total stores do we currently have in our inventory?",
        "Can you check if SKU-8899 is in stock anywhere?",
        "Hello!",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "id long, text string")
    got = {(r.id, r.route) for r in rag.route_questions(df).collect()}
    assert got == {(0, "document_search"), (1, "warehouse_query"), (2, "sku_inventory"), (3, "chat")}


def test_inventory_replies(spark):
    stock = spark.createDataFrame([("SKU-123", 5), ("SKU-999", 0)], "sku string, stock int")
    asked = spark.createDataFrame([("SKU-123",), ("SKU-999",), ("SKU-1",)], "sku string")
    got = {r.sku: r.reply for r in rag.check_inventory(asked, stock).collect()}
    assert got == {"SKU-123": "5 items in stock", "SKU-999": "Out of stock", "SKU-1": "SKU not found in inventory database."}


def test_row_filter(spark):
    rows = spark.createDataFrame([(1, "NA"), (2, "eu"), (3, None)], "id long, region string")
    members = spark.createDataFrame([("a", "global_admins"), ("b", "region_na")], "user string, group string")
    seen = lambda user: sorted(r.id for r in search.rows_for_user(rows, members, user).collect())
    assert seen("a") == [1, 2, 3] and seen("b") == [1] and seen("nobody") == []
    hits = spark.createDataFrame([("b", 1), ("b", 2), ("a", 3), ("nobody", 1)], "user string, id long")
    bad = search.policy_violations(hits, rows, members, "id").collect()
    assert {(r.user, r.id) for r in bad} == {("b", 2), ("nobody", 1)}


def test_fusion_and_order(spark):
    one = spark.createDataFrame([(1, 1, 10), (1, 2, 11)], "question_id long, rank int, id long")
    two = spark.createDataFrame([(1, 1, 11), (1, 2, 12)], "question_id long, rank int, id long")
    got = [(r.id, r.score) for r in search.fuse(one, two, k=3).orderBy("rank").collect()]
    assert got == [(11, round(1 / 62 + 1 / 61, 6)), (10, round(1 / 61, 6)), (12, round(1 / 62, 6))]
    hits = spark.createDataFrame([(1, r) for r in range(1, 7)], "question_id long, rank int")
    order = [r.rank for r in search.order_for_context(hits).orderBy("position").collect()]
    assert order == [1, 3, 5, 6, 4, 2]


def test_registry_refuses_and_caps(spark):
    views = rag.ViewRegistry({"v": spark.range(50)})
    assert views.run("v", lambda v: v, order_by=("id",)).count() == 10
    assert views.run("v", lambda v: v.agg(F.count("id")), aggregated=True).first()[0] == 50
    with pytest.raises(PermissionError):
        views.run("secret", lambda v: v)


def test_embedding_is_unit_length_and_deduplicated(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "..."), (4, None)], "id long, t string")
    out = {r.id: r.embedding_vector for r in infer.embed(df, "t", "id").collect()}
    assert out[1] == out[2] and abs(sum(x * x for x in out[1]) - 1) < 1e-6
    assert out[3] is None and out[4] is None and len(out[1]) == config.EMBEDDING_DIM


def test_retry_reports_and_requeues(spark):
    def flaky(value: str, attempt: int) -> str:
        if value == "never" or (value == "twice" and attempt == 1):
            raise RuntimeError("busy")
        return value.upper()

    df = spark.createDataFrame([(1, "ok"), (2, "twice"), (3, "never"), (4, None)], "id long, t string")
    out = infer.infer_with_retry(df, "t", flaky, max_attempts=3, concurrency=2)
    rows = {r.id: (r.status, r.attempts, r.error) for r in out.collect()}
    assert rows[1] == ("OK", 1, None) and rows[2] == ("OK", 2, None)
    assert rows[3] == ("ERROR", 3, "busy")
    assert sorted(r.id for r in infer.requeue(out, "id").collect()) == [3, 4]



def test_question_blocks_share_two_reads_of_the_documents(spark, tmp_path, monkeypatch):
    docs = [(i, f"common word{i % 7} word{i % 11} " * (1 + i % 4)) for i in range(200)]
    marks = tmp_path / "reads"
    marks.mkdir()

    def marked(batches):
        import uuid

        (marks / uuid.uuid4().hex).touch()
        yield from batches

    read = spark.createDataFrame(docs, "id long, text string").coalesce(1).mapInArrow(marked, "id long, text string")
    asked = [(q, f"common word{q} word{q + 3}") for q in range(8)]
    questions = spark.createDataFrame(asked, "id long, text string")
    got = listed(search.bm25(questions, read, 5, question_terms=3))
    assert got == brute_bm25(docs, asked, 5) and len(list(marks.iterdir())) == 2
    monkeypatch.setattr(search, "SCAN_TERMS", 7)
    assert listed(search.bm25(questions, read, 5, question_terms=3)) == got


def test_keyword_kernel_holds_slices(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    from shelfwise.functions import keywords

    rng = np.random.default_rng(3)
    names = [f"w{i}" for i in range(40)]
    asked = pa.table({"question_id": np.repeat(np.arange(200), 40).tolist(), "term": names * 200})
    terms = keywords.QuestionTerms.build(asked, pa.array(names), np.full(40, 5000.0), 10_000, 60.0, 1.2, 0.75)
    words = [[names[i] for i in rng.integers(0, 40, 60)] for _ in range(5_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5_000)), pa.array(words)], names=["id", "tokens"])
    best = keywords.KeywordK(terms, 5)
    tracemalloc.start()
    best.add(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 and best.batch(pa.int64(), pa.int64()).num_rows == 1000


def test_embedding_kernel_is_bounded(spark, monkeypatch):
    """Slices of a batch embed as the batch does, and only so many tokens are remembered."""
    assert kernel._slot.cache_info().maxsize <= 100_000
    rows = [(i, f"word{i % 13} word{i % 7} " * (i % 5)) for i in range(60)] + [(60, None), (61, "...")]
    df = spark.createDataFrame(rows, "id long, t string").coalesce(1)
    assert df.rdd.getNumPartitions() == 1
    wanted = {r.id: r.v for r in df.select("id", kernel.hashed_embedding(F.col("t")).alias("v")).collect()}
    monkeypatch.setattr(kernel, "TEXT_AT_ONCE", 100)
    got = {r.id: r.v for r in df.select("id", kernel.hashed_embedding(F.col("t")).alias("v")).collect()}
    assert got == wanted and got[60] is None and got[61] is None
