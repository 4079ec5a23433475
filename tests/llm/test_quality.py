from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import quality
from shelfwise.llm.folds import fold


def plain(text):
    """The statistics of one text, one by one."""
    text = text or ""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    sizes = [len(w.encode()) for w in words]
    n, full = max(len(words), 1), max(sum(sizes), 1)
    stops = set(".,;:?'\"()-")
    signs = [c for c in text if "!" <= c <= "~" and not c.isalnum() and c not in stops]
    signs += [c for c in text if c == "\x7f"]
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        len(text), len(words), sum(sizes) / n, max(sizes, default=0), sum(s <= 2 for s in sizes) / n,
        len(re.findall("[A-Z]", text)) / full, len(re.findall("[0-9]", text)) / full, sum(c in stops for c in text) / full,
        len(signs) / full, sum(ord(c) > 127 for c in text) / full, text.count("\n") / n, same / n,
        len(set(words)) / n, max(Counter(words).values(), default=0) / n,
    ]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.lists(st.sampled_from(["a", "A", "é", "🙂", " ", "\n", "!", "#", ".", "7", "the the", "\t"])).map("".join), max_size=6))
def test_statistics_equal_a_plain_version(texts):
    found = quality.statistics(pa.array(texts, pa.string()))
    assert found.shape == (len(texts), len(quality.STATISTICS))
    for row, text in zip(found, texts):
        assert row.tolist() == pytest.approx(plain(text))


def test_held_out_accuracy(spark):
    """On documents it did not learn from, the rules tell the marked kinds apart."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.op5_quality(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.97


def test_column_equals_the_rules(spark, documents):
    model = quality.train(documents, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"), fold("doc_id") != 0)
    rows = quality.with_statistics(documents, "text", ["doc_id"]).select("_statistics.*", model.column().alias("score")).toPandas()
    stats = rows[list(quality.STATISTICS)].to_numpy()
    margin = model.intercept + sum(w * rule.holds(stats) for rule, w in model.rules)
    assert rows["score"].to_numpy() == pytest.approx(1 / (1 + np.exp(-margin))) and model.rules


def test_lasso_drops_useless_rules():
    random = np.random.default_rng(0)
    labels = (random.random(2000) < 0.5).astype(float)
    noise = (random.random((2000, 30)) < 0.3).astype(float)
    _, weights = quality.lasso(np.concatenate([labels[:, None], noise], axis=1), labels, penalty=0.02)
    assert weights[0] > 1 and not weights[1:].any()


def test_degenerate_labels(spark, documents):
    empty_labels = spark.createDataFrame([], "doc_id bigint, quality int")
    none = quality.train(documents, empty_labels, fold("doc_id") != 0)
    assert none.rules == [] and none.intercept == 0
    ones = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (3, None), (None, 0)], "doc_id bigint, quality int")
    model = quality.train(documents, ones, fold("doc_id") >= 0)
    assert model.rules == [] and model.intercept == pytest.approx(np.log(4))


def test_repeated_ids_do_not_grow_the_sample(spark, monkeypatch):
    rows = [(0, f"the same id with other words {i}") for i in range(300)] + [(i, f"text number {i} of them") for i in range(1, 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(20)], "doc_id bigint, quality double")
    sizes = []
    monkeypatch.setattr(quality, "fit", lambda rows, labels: sizes.append(len(labels)))
    quality.train(docs, labels, fold("doc_id") >= 0, sample=10)
    quality.train(docs, labels, fold("doc_id") >= 0)
    assert sizes == [10, 20]


def test_odd_rows(spark, odd, empty):
    model = quality.Ensemble(0.0, [(quality.Rule(((1, True, 5.0),)), 2.0)])
    assert quality.score(odd, model).count() == odd.count()
    kept = quality.keep_good(odd, model, threshold=0.6)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {1, 2, None, 8, 9}
    assert quality.keep_good(empty, model).count() == 0 and quality.score(empty, model).count() == 0
