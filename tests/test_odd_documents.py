"""Builds of documents without a language, and of texts whose token counts cancel out, against their SQL."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from shelfwise import config
from shelfwise.functions.vectors import _slot
from shelfwise.operators import infer
from shelfwise.plans.retrieval import text_vectors


def cancelling() -> str:
    """Two words of one slot and opposite signs."""
    seen = {}
    for word in (f"w{i}" for i in range(10_000)):
        slot, sign = _slot(word, config.EMBEDDING_DIM)
        if (slot, -sign) in seen:
            return f"{seen[slot, -sign]} {word}"
        seen[slot, sign] = word
    raise AssertionError("no pair")


def documents() -> list[tuple]:
    texts = ["espresso machine return policy", cancelling(), "...", None, "", "blender warranty " * 60]
    origin = [("en", "src1"), (None, "src2"), ("es", None), ("fr", "src3"), (None, None), ("de", "src7")]
    rows = [(text, lang, source) for text in texts for lang, source in origin]
    return [(i, text, lang, source, len(text or "")) for i, (text, lang, source) in enumerate(rows)]


@pytest.mark.parametrize("key", ["document_build", "live_index"])
def test_build_matches_sql(spark, tmp_path, key):
    rows = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long")
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cursor = con.execute(entry.oracle_sql()[key])
    names, want = [d[0] for d in cursor.description], sorted(map(str, cursor.fetchall()))
    got = entry.queries()[key](spark, str(tmp_path)).select(*names)
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert len(want) > 10


def test_zero_vector_is_searched_by_nobody(spark):
    df = spark.createDataFrame([(1, cancelling()), (2, "espresso machine"), (3, "..."), (4, None)], "id long, text string")
    out = {r.id: r.embedding_vector for r in infer.embed(df, "text", "id").collect()}
    assert out[1] == [0.0] * config.EMBEDDING_DIM and out[3] is None and out[4] is None
    assert [r.id for r in text_vectors(df).collect()] == [2]
