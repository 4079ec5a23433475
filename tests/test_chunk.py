"""Chunker against a slow restatement of its contract, and its invariants."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.operators import chunk


def greedy(pieces, size, overlap):
    """Pack (start, end) pieces one by one, keeping the longest allowed tail on overflow."""
    out, window = [], []
    for piece in pieces:
        if window and piece[1] - window[0][0] > size:
            out.append((window[0][0], window[-1][1]))
            while window and (window[-1][1] - window[0][0] > overlap or piece[1] - window[0][0] > size):
                window.pop(0)
        window.append(piece)
    if window:
        out.append((window[0][0], window[-1][1]))
    return out


def pieces_of(text, begin, end, sep):
    if not sep:
        return [(i, i + 1) for i in range(begin, end)]
    out, at = [], begin
    for part in text[begin:end].split(sep):
        if part:
            out.append((at, at + len(part)))
        at += len(part) + len(sep)
    return out


def brute(text, begin, end, size, overlap, seps):
    chosen = next((s for s in seps if s in text[begin:end]), seps[-1])
    rest = seps[seps.index(chosen) + 1 :]
    out, run = [], []
    for piece in pieces_of(text, begin, end, chosen):
        if piece[1] - piece[0] <= size:
            run.append(piece)
        else:
            out += greedy(run, size, overlap) + brute(text, *piece, size, overlap, rest)
            run = []
    return out + greedy(run, size, overlap)


TEXT = st.text(alphabet="ab \n", max_size=200)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.integers(4, 30), st.integers(0, 4))
def test_matches_brute_force(text, size, overlap):
    got = chunk.split_spans(text, size, overlap)
    want = brute(text, 0, len(text), size, overlap, ("\n\n", "\n", " ", "")) if text.strip() else []
    assert got == want


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(4, 30), st.integers(0, 4))
def test_invariants(text, size, overlap):
    spans = chunk.split_spans(text, size, overlap)
    covered = set()
    for (begin, end), following in zip(spans, [*spans[1:], None]):
        assert 0 < end - begin <= size
        covered.update(range(begin, end))
        if following:
            assert following[0] > begin
            assert end - following[0] <= overlap
    assert all(i in covered for i, c in enumerate(text) if not c.isspace())


def test_long_word_falls_back_to_characters():
    spans = chunk.split_spans("x" * 1200)
    assert spans[0] == (0, 500)
    assert spans[-1][1] == 1200
    assert all(e - b <= 500 for b, e in spans)


def test_null_blank_and_keys(spark):
    rows = [(1, None), (2, "  \n "), (3, "one two"), (4, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, extracted_text string")
    out = chunk.with_chunk_ids(chunk.chunk_documents(df, "doc_id")).collect()
    assert sorted((r.doc_id, r.ordinal, r.chunk_content) for r in out) == [(3, 0, "one two"), (4, 0, "one two")]
    assert out[0].chunk_id == out[1].chunk_id
    assert out[0].chunk_key != out[1].chunk_key


def test_chunker_runs_once(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, extracted_text string").repartition(2)
    plan = chunk.chunk_documents(df, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_nested_headings(spark):
    md = "intro\n# A\none\n## B\ntwo\nthree\n# C\n"
    rows = chunk.chunk_headings(spark.createDataFrame([(1, md)], "id long, md string"), "md", "id").collect()
    got = sorted((r.section, r.heading, r.chunk_content) for r in rows)
    assert got == [(0, None, "intro"), (1, "A", "one"), (2, "B", "two\nthree"), (3, "C", "")]


def test_parent_child_links(spark):
    text = " ".join(f"w{i:03d}" for i in range(400))
    df = spark.createDataFrame([(7, text)], "k long, t string")
    rows = chunk.parent_child(df, "k", "t", parent_size=600, size=100, overlap=10).collect()
    parents = [text[b:e] for b, e in chunk.split_spans(text, 600, 0)]
    for row in rows:
        assert row.text.split()[0] in parents[int(row.parent_id.split("#")[1])]
    assert {r.parent_id for r in rows} == {f"7#{i}" for i in range(len(parents))}


def test_stats(spark):
    df = spark.createDataFrame([(1, "ab"), (1, "abcd"), (2, "x" * 600)], "d long, chunk_content string")
    got = {r.d: (r.n_chunks, r.max_chars, r.over_limit) for r in chunk.chunk_stats(df, "d").collect()}
    assert got == {1: (2, 4, 0), 2: (1, 600, 1)}
    assert chunk.chunk_paragraphs(df.withColumn("chunk_content", F.lit("a\n\n b ")), "chunk_content", "d").count() == 6


def test_chunks_of_one_batch_keep_to_their_rows(spark, monkeypatch):
    """Rows come back as Arrow columns: empty, missing and failing texts between others, and no dict per chunk."""
    split = chunk.split_spans

    def failing(text, *rest):
        if text.startswith("bad"):
            raise ValueError(text)
        return split(text, *rest)

    monkeypatch.setattr(chunk, "split_spans", failing)
    texts = ["one two three", None, "", "  \n", "bad text", "four " * 300, "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").coalesce(1)
    out = {r.id: r.c for r in df.select("id", chunk.chunk_array(F.col("t"), 20, 5).alias("c")).collect()}
    assert out[1] == out[2] == out[3] == [] and out[4] is None
    assert [tuple(c) for c in out[0]] == [(0, 0, "one two three")] and [tuple(c) for c in out[6]] == [(0, 0, "x")]
    assert [c.ordinal for c in out[5]] == list(range(len(out[5]))) and all(texts[5][c.start :].startswith(c.text) for c in out[5])
