"""Input that must neither stop a job nor lose or change rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import chunk, evaluate, guard, infer, monitor, rag, search, text, warehouse
from shelfwise.session import hot_keys, scratch_dir
from shelfwise.sources import files
from shelfwise.streaming import ingest as stream

INF, NAN = float("inf"), float("nan")


def test_non_finite_vectors_are_rejected_and_never_crowd_out_hits(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [INF, 1.0]), (3, [NAN, 1.0]), (4, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>").coalesce(1)
    kept, rejected = infer.dimension_guard(df, "vector", 2)
    assert sorted(r.id for r in kept.collect()) == [0, 1, 4]
    assert {(r.id, r.reject_reason) for r in rejected.collect()} == {(2, "not_a_number"), (3, "not_a_number")}
    asked = df.filter("id = 0")
    for k, wanted in ((1, [1]), (2, [1, 4])):
        hits = search.knn(asked, df, k, skip_same=True, dim=2).orderBy("rank").collect()
        assert [h.id for h in hits] == wanted


def test_null_partitions_are_rewritten_whole(spark):
    path = scratch_dir(spark, "table")
    files.overwrite(spark.createDataFrame([(1, None), (2, None), (3, "a/b"), (4, "c")], "id long, part string"), path, "part")
    added = spark.createDataFrame([(5, None)], "id long, part string")
    touched = spark.createDataFrame([(None,), ("a/b",)], "part string")
    files.rewrite_partitions(spark, path, "part", touched, lambda now: now.filter("id <> 3").unionByName(added))
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 4, 5]
    files.rewrite_partitions(spark, path, "part", touched, lambda now: now.filter("false"))
    assert [r.id for r in spark.read.parquet(path).collect()] == [4]


def test_malformed_bytes_become_a_marker(spark):
    rows = [(1, b"<p>good</p>"), (2, b"<p>\xff\xfe bad</p>"), (3, None)]
    out = {r.k: r.extracted_text for r in text.extract_html(spark.createDataFrame(rows, "k long, content binary")).collect()}
    assert out[1] == "good" and out[2].startswith("<ERROR") and out[3] is None


def test_bad_lines_go_to_quarantine(spark):
    body = b'{"a": 1}\nnot json\n\n{"a": 2, "s": "\xff"}\n{"a": "x"}\n'
    bronze = spark.createDataFrame([("f", body), ("g", b'{"a": 3}')], "path string, content binary")
    assert sorted(r.a for r in files.file_lines(bronze, "a long, s string").collect()) == [1, 2, 3]
    assert sorted(r.line for r in files.bad_lines(bronze, "a long, s string").collect()) == ["not json", '{"a": "x"}']


def test_corrupt_stream_rows_do_not_land_as_nulls(spark):
    landing, table, checkpoint = (scratch_dir(spark, n) for n in ("landing", "table", "checkpoint"))
    spark.createDataFrame([('{"id": 1}',), ("broken",), ('{"id": 2}',)], "value string").write.text(landing + "/x")
    rows = stream.json_rows(spark, landing + "/*", "id long")
    stream.drain(stream.good_rows(rows), table, checkpoint)
    assert sorted(r.id for r in spark.read.schema("id long").parquet(table).collect()) == [1, 2]


def test_months_without_a_month_before(spark):
    rows = [(1, "2024-01", 0), (1, "2024-02", 5), (1, "2024-04", 1), (1, "2024-05", 10)]
    monthly = spark.createDataFrame(rows, "store_id long, month string, total_revenue long")
    got = {r.month: (r.pct_change, r.dropped) for r in warehouse.month_over_month(monthly).collect()}
    assert got == {"2024-01": (None, False), "2024-02": (None, False), "2024-04": (None, False), "2024-05": (9.0, False)}


def test_rates_of_nothing_are_null(spark):
    flags = spark.createDataFrame([], "p boolean, a boolean")
    assert guard.confusion(flags, "p", "a").first().block_rate is None
    marks = spark.createDataFrame([], "j int, h int")
    row = evaluate.agreement(marks, "j", "h").first()
    assert row.agreement is None and row.kappa is None


def test_unreadable_attributes_and_negative_series(spark):
    spans = spark.createDataFrame(
        [("t", "a", 1.0, "OK", {"tokens": "many"}, 1), ("t", "b", 2.0, "OK", {"tokens": "5"}, 2)],
        "trace_id string, name string, latency double, status string, attributes map<string,string>, event_id long",
    )
    assert monitor.trace_rollup(spans).first().tokens == 5
    steady = spark.createDataFrame([("s", f"2024-01-0{d}", -10.0) for d in range(1, 6)], "series string, ts string, value double")
    assert not any(r.drifted for r in monitor.quality_trend(steady, "series", "ts", "value").collect())


def test_short_words_are_topics(spark):
    df = spark.createDataFrame([("d", "tv 電 tv the")], "day string, q string")
    assert {r.topic for r in monitor.topics(df, "day", "q").collect()} == {"tv", "電"}


def test_hits_on_unknown_rows_are_violations(spark):
    hits = spark.createDataFrame([("bo", 1), ("bo", 2), ("bo", 9), ("ada", 9)], "user string, doc long")
    rows = spark.createDataFrame([(1, "FR"), (2, "IT")], "doc long, region string")
    groups = spark.createDataFrame([("bo", "region_fr"), ("ada", "global_admins")], "user string, group string")
    bad = search.policy_violations(hits, rows, groups, "doc").collect()
    assert sorted((r.user, r.doc) for r in bad) == [("bo", 2), ("bo", 9)]


def test_a_rerun_replaces_its_day(spark):
    path = scratch_dir(spark, "metrics")
    day = spark.createDataFrame([("m", 1.0, "2024-01-01")], "metric string, mean double, day string")
    files.replace_partitions(day.withColumn("day", F.lit("2024-01-02")), path, "day")
    for _ in range(2):
        files.replace_partitions(day, path, "day")
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize("listed", [10_000, 0])
def test_boilerplate_routes_agree(spark, listed):
    rows = [(1, "a\nsame"), (2, "b\nsame"), (2, "c\nsame"), (3, None), (4, ""), (5, "same")]
    out = text.strip_boilerplate_lines(spark.createDataFrame(rows, "k long, t string"), "k", "t", 3, listed).collect()
    got = sorted(((r.k, r.clean_text, r.lines_removed) for r in out), key=str)
    assert got == sorted([(1, "a", 1), (2, "b", 1), (2, "c", 1), (3, None, None), (4, "", 0), (5, "", 1)], key=str)


def test_keyword_search_with_nulls_and_repeated_ids(spark):
    corpus = spark.createDataFrame([(1, "red cat"), (2, None), (3, "cat"), (3, "cat dog"), (4, None)], "id long, text string")
    asked = spark.createDataFrame([(i, "cat dog red") for i in range(5)], "id long, text string")
    one = sorted(search.bm25(asked, corpus, 5).collect())
    many = sorted(search.bm25(asked, corpus, 5, question_terms=4).collect())
    assert one == many and len(one) == 15


def test_every_parent_with_a_good_child_comes_back(spark):
    children = [(f"p{p}", f"return policy number {c}") for p in range(10) for c in range(40)] + [("q", "nothing")]
    asked = spark.createDataFrame([(1, "return policy")], "id long, text string")
    df = spark.createDataFrame(children, "parent_id string, text string").repartition(3)
    assert [r.id for r in search.search_parents(asked, df, 10).orderBy("rank").collect()] == [f"p{i}" for i in range(10)]


def test_a_document_that_cannot_be_split_is_reported(spark, monkeypatch):
    def fail(value, *_):
        raise ValueError(value)

    df = spark.createDataFrame([(1, "some text"), (2, None)], "k long, t string")
    monkeypatch.setattr(chunk, "split_spans", fail)
    rows = [r.asDict() for r in chunk.failed_documents(df.withColumn("c", chunk.chunk_array(F.col("t"))), "c").collect()]
    assert rows in ([{"k": 1, "t": "some text", "reject_reason": "split_failed"}], [])  # workers may import the module afresh


def test_a_heading_without_a_body_stays(spark):
    df = spark.createDataFrame([(1, "before\n# A\none\n\n two \n## Empty\n# B\nthree"), (2, None), (3, "# Only")], "k long, md string")
    rows = sorted((r.k, r.section, r.heading, r.chunk_content) for r in chunk.chunk_headings(df, "md", "k").collect() if r.heading)
    assert rows == [(1, 1, "A", "one\ntwo"), (1, 2, "Empty", ""), (1, 3, "B", "three"), (3, 1, "Only", "")]


def test_overlap_is_narrow_and_counts_grams(spark):
    df = spark.createDataFrame([("x", "a b b c", "b b d"), ("y", None, "b"), ("z", None, None)], "k string, l string, r string")
    found = evaluate.overlap(df, "k", "l", "r")
    assert {r.k: tuple(r)[1:] for r in found.collect()} == {"x": (4, 3, 2, 4, 6, 5), "y": (0, 1, 0, 0, 0, 1), "z": (0,) * 6}
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_by_bucket(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in hot_keys(df, ["k"], 500).collect()] == [-1]
    assert hot_keys(df, ["k"], 1000).count() == 0


def test_blocks_never_mix_scopes(spark, monkeypatch):
    monkeypatch.setattr(search, "QUESTION_BLOCK", 3)
    monkeypatch.setattr(search, "CORPUS_BLOCK", 4)
    rows = [(i, [float(i % 7 + 1), float(i % 5)], i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, vector array<double>, scope int")
    asked = df.filter("id < 20")
    wanted = sorted(map(tuple, search.knn(asked, df, 4, True, dim=2).collect()))
    assert sorted(map(tuple, search.knn(asked, df, 4, True, question_bytes=0, dim=2).collect())) == wanted


def test_models_plug_in(spark):
    """Answers, judge and routes take any function; failures are rows, and another attempt waits longer each time."""
    prompts = spark.createDataFrame(
        [(1, "one", None, ["s"]), (2, "bad", None, ["s"]), (3, None, "no context", [])],
        "question_id long, prompt string, answer string, citations array<string>",
    )

    def model(prompt: str, attempt: int) -> str:
        if prompt == "bad" or attempt == 1:
            raise RuntimeError("busy")
        return prompt.upper()

    rows = {r.question_id: r for r in rag.model_answers(prompts, model, backoff=0.01).collect()}
    assert (rows[1].answer, rows[1].attempts, rows[2].status, rows[3].answer) == ("ONE", 2, "ERROR", "no context")
    assert [r.question_id for r in infer.requeue(rag.model_answers(prompts, model), "question_id").collect()] == [2]

    pairs = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, None, "b")], "k long, p string, t string")
    judge = evaluate.model_judge(lambda prompt, attempt: "YES" if "Answer: a" in prompt and "Truth: a" in prompt else "NO")
    verdicts = {r.k: r.value for r in evaluate.judge(pairs, "k", "p", {"correct": "t"}, by=judge).collect()}
    assert verdicts == {1: 1.0, 2: 0.0, 3: 0.0}

    asked = spark.createDataFrame([("where is my parcel",), ("hello",), ("why",)], "text string")
    routed = [r.route for r in rag.route_questions(asked, routes=(("tracking", "parcel"),), other="human").collect()]
    assert routed == ["tracking", "chat", "human"]


def test_rows_for_all_users_equal_those_of_each(spark):
    rows = spark.createDataFrame([(1, "FR"), (2, "de"), (3, None), (4, "ES")], "doc long, region string")
    groups = spark.createDataFrame(
        [("ada", "global_admins"), ("ada", "region_fr"), ("bo", "region_fr"), ("bo", "region_de"), ("di", "other")], "user string, group string"
    )
    together = sorted((r.user, r.doc) for r in search.rows_for_users(rows, groups).collect())
    each = [(u, r.doc) for u in ("ada", "bo", "di") for r in search.rows_for_user(rows, groups, u).collect()]
    assert together == sorted(each) and len(each) == 6
