"""Batch inference on odd texts, against the SQL of the registered query."""

from __future__ import annotations

import duckdb
import pytest

from shelfwise.operators import infer
from shelfwise.plans import retrieval

TEXTS = ["ßtraße", "ﬁnal", "ᾳ", "ŉ", "éclair", "éa", "", "abcdefg", None, "zz", "1a"]


@pytest.mark.parametrize("key", ["batch_infer_retry"])
def test_inference_matches_sql_on_odd_texts(spark, key):
    rows = list(enumerate(TEXTS))
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = infer.infer_with_retry(documents, "text", retrieval.flaky_model).drop("text")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cursor = con.execute(retrieval.ORACLE[key])
    names = [d[0] for d in cursor.description]
    want = sorted(cursor.fetchall())
    assert sorted(tuple(r) for r in got.select(*names).collect()) == want
    assert len(want) == len(TEXTS)


def test_every_letter_has_one_upper_case():
    letters = [chr(code) for code in range(1, 0x110000) if not 0xD800 <= code <= 0xDFFF]
    con = duckdb.connect()
    want = con.execute("SELECT upper(c) FROM (SELECT unnest(?) AS c)", [letters]).fetchall()
    assert [retrieval.upper_letter(c) for c in letters] == [u for (u,) in want]
