"""Extraction markers, whitespace and templates on literal rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import text as ft
from shelfwise.operators import text


def test_whitespace_matches_python(spark):
    samples = ["a b", " a\t\n b ", "a\u0085b\x1c\x1fc", " x　", "", "plain"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r[0] for r in df.select(ft.normalize_whitespace(F.col("t"))).collect()]
    assert got == [re.sub(r"\s+", " ", s).strip() for s in samples]


def test_markers(spark):
    def decode(payload: bytes) -> str:
        if payload == b"bad":
            raise ValueError("no pages")
        return payload.decode()

    rows = [(1, b"a  b"), (2, b" \n "), (3, b"bad"), (4, None)]
    df = spark.createDataFrame(rows, "id long, content binary")
    out = {r.id: r.extracted_text for r in text.extract_with(decode, df).collect()}
    assert out == {
        1: "a b",
        2: "<ERROR: IMAGE_ONLY_NO_TEXT_EXTRACTED>",
        3: "<ERROR: EXCEPTION_DURING_EXTRACTION: no pages>",
        4: None,
    }


def test_errors_and_nulls_are_dropped_but_quarantined(spark):
    rows = [(1, "fine"), (2, None), (3, config.ERROR_NO_TEXT), (4, "<ERROR: EXCEPTION_DURING_EXTRACTION: x>")]
    df = spark.createDataFrame(rows, "id long, extracted_text string")
    assert [r.id for r in text.drop_extraction_errors(df).collect()] == [1]
    kept, rejected = text.quarantine_split(df)
    assert [r.id for r in kept.collect()] == [1]
    assert {r.id: r.reject_reason for r in rejected.collect()} == {2: "no_content", 3: "image_only", 4: "extraction_failed"}


def test_entities(spark):
    """Named and numeric entities, each decoded once; what is none stays."""
    cases = {
        "caf&eacute; &#233;&#xE9;&#Xe9;": "café ééé", "&#128512;&rarr;&euro;": "😀→€", "&amp;lt; &#38;lt; &am&#112;;": "&lt; &lt; &amp;",
        "a&nbsp;b&#39;&apos;": "a b''", "&nosuch; & AT&T; x&y": "&nosuch; & AT&T; x&y", "&#0;&#xD800;&#9999999;": "\ufffd\ufffd\ufffd",
        "": "", "plain": "plain", "&lt;&gt;": "<>",
    }
    df = spark.createDataFrame([(t,) for t in [*cases, None]], "t string")
    got = [r[0] for r in df.select(ft.decode_entities(F.col("t"))).collect()]
    assert got == [*cases.values(), None]


def test_html(spark):
    html = "<html><script>var t='<p>';</script><style>p{}</style><!-- no --><p>a&amp;lt;b</p><p>c&nbsp;d</p></html>"
    df = spark.createDataFrame([(bytearray(html.encode()),), (None,)], "content binary")
    assert [r[0] for r in text.extract_html(df).collect()] == ["a&lt;b c d", None]


@pytest.mark.parametrize("listed", [100, 0])
def test_boilerplate(spark, listed):
    rows = [(1, "menu\none\nfoot\x00er"), (2, "menu\ntwo\nfooter"), (3, "menu\nthree"), (4, "menu")]
    df = spark.createDataFrame(rows, "id long, t string")
    out = {r.id: (r.clean_text, r.lines_removed) for r in text.strip_boilerplate_lines(df, "id", "t", 3, listed).collect()}
    assert out == {1: ("one\nfooter", 1), 2: ("two\nfooter", 1), 3: ("three", 1), 4: ("", 1)}


def test_prompt_text(spark):
    row = spark.range(1).select(ft.rag_prompt(F.lit("CTX {question}"), F.lit("Why?"), "Acme").alias("p")).first()
    lines = row.p.split("\n")
    assert lines[0] == "You are a helpful assistant for Acme retail employees."
    assert lines[4] == " " * 12 + "CONTEXT:"
    assert lines[5] == " " * 12 + "CTX {question}"
    assert lines[8] == " " * 12 + "Why?"
    assert lines[10] == " " * 12 + "ANSWER:"


def test_preview(spark):
    df = spark.createDataFrame([(None, "x" * 100), (None, None), ("q", "p")], "a string, b string")
    got = [r[0] for r in df.select(ft.preview(F.col("a"), F.col("b"))).collect()]
    assert got == ["x" * 80 + "...", "N/A...", "q..."]


def test_ngrams_and_tokens(spark):
    df = spark.createDataFrame([("A b-c", ), ("x",), ("",), (None,)], "t string")
    got = [tuple(r) for r in df.select(ft.tokens(F.col("t")), ft.ngrams(ft.tokens(F.col("t")), 2), ft.token_count(F.col("t"))).collect()]
    assert got[0] == (["a", "b", "c"], ["a b", "b c"], 3)
    assert got[1] == (["x"], [], 1)
    assert got[2] == ([], [], 0)
