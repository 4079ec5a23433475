from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.llm import scoring
from shelfwise.llm.folds import fold


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


class Plain:
    """PPM and base scores of texts, symbol by symbol."""

    def __init__(self, training):
        self.contexts = [defaultdict(Counter) for _ in range(3)]
        self.words, self.ends = Counter(), len(training)
        for text in training:
            self.words.update(re.findall(r"[^\x20\x09-\x0D]+", lowered(text)))
            data = b"\xff\xff" + (text or "").encode() + b"\xff"
            for at in range(2, len(data)):
                for k in range(3):
                    self.contexts[k][data[at - k : at]][data[at]] += 1
        self.n = sum(self.words.values()) + self.ends
        self.below = self.n + 0.5 * (len(self.words) + (self.ends > 0) + 1)

    def symbol(self, data, at):
        chance, excluded = 1.0, set()
        for k in (2, 1, 0):
            left = {s: n for s, n in self.contexts[k][data[at - k : at]].items() if s not in excluded}
            if left:
                size = sum(left.values()) + len(left)
                if data[at] in left:
                    return chance * left[data[at]] / size
                chance, excluded = chance * len(left) / size, excluded | set(left)
        return chance / (256 - len(excluded))

    def score(self, text):
        data = b"\xff\xff" + (text or "").encode() + b"\xff"
        return sum(math.log10(self.symbol(data, at)) for at in range(2, len(data)))

    def base(self, text):
        tokens = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        value = sum(math.log10((self.words[t] + 0.5) / self.below) for t in tokens) + math.log10((self.ends + 0.5) / self.below)
        return len(tokens) + 1, sum(self.words[t] > 0 for t in tokens) + (self.ends > 0), value


def held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 == 1


def compare(df, long_from=20_000):
    rows = df.select("doc_id", "text").collect()
    plain = Plain([r.text for r in rows if not held(r.doc_id)])
    got = sorted((tuple(r) for r in scoring.score_documents(df, fold("doc_id") == 1).collect()), key=lambda r: (str(r[0]), r[2], r[6]))
    wanted = sorted(
        ((r.doc_id, held(r.doc_id), *plain.base(r.text)[:2], plain.n, plain.base(r.text)[2], plain.score(r.text) if len(r.text or "") < long_from else None) for r in rows),
        key=lambda r: (str(r[0]), r[2], r[6] or 0),
    )
    assert len(got) == len(wanted)
    for g, w in zip(got, wanted):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5])
        assert w[6] is None or g[6] == pytest.approx(w[6], rel=1e-5, abs=1e-4)


def test_equals_plain_version(spark, documents):
    compare(documents.filter("length(text) < 1500"))


def test_word_lists_of_many_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(scoring, "DICTIONARY_BYTES", 3000)
    compare(documents.filter("length(text) < 800"))


def test_odd_rows(spark, odd, empty):
    compare(odd, 5000)
    assert scoring.score_documents(empty, fold("doc_id") == 1).count() == 0
    everything = scoring.score_documents(odd.limit(3), F.lit(True)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in everything)


def test_chances_sum_to_one(spark, documents):
    lengths = scoring.code_lengths(*scoring.train_trie(documents.select("text")))
    sums = (10.0 ** lengths.table.astype(np.float64)).sum(axis=1)
    assert sums == pytest.approx(1, abs=1e-3)


def test_model_beats_uniform_on_held_out_texts(spark, documents):
    rows = scoring.score_documents(documents, fold("doc_id") == 1).join(documents.select("doc_id", "text"), "doc_id").filter("held_out").collect()
    bits = -sum(r.score for r in rows) * math.log2(10) / sum(len(r.text.encode()) + 1 for r in rows)
    assert bits < 3.5


class Deep(Plain):
    """The same with the chances after three and more bytes blended, each over the next shorter context."""

    def __init__(self, training, order):
        super().__init__(training)
        self.order, self.deeper = order, defaultdict(Counter)
        for text in training:
            data = b"\xff" * order + (text or "").encode() + b"\xff"
            for at in range(order, len(data)):
                for k in range(3, order + 1):
                    self.deeper[data[at - k : at]][data[at]] += 1

    def score(self, text):
        data, total = b"\xff" * self.order + (text or "").encode() + b"\xff", 0.0
        for at in range(self.order, len(data)):
            chance = self.symbol(data, at)
            for k in range(3, self.order + 1):
                seen = self.deeper.get(data[at - k : at])
                if seen:
                    chance = (seen[data[at]] + len(seen) * chance) / (sum(seen.values()) + len(seen))
            total += math.log10(chance)
        return total


@pytest.mark.parametrize("order", [3, 5, 6])
def test_deeper_contexts_equal_the_plain_version(spark, documents, odd, empty, order, monkeypatch):
    monkeypatch.setattr(scoring, "DICTIONARY_BYTES", 20_000)  # many blocks: counts meet in the buckets
    for df in (documents.filter("length(text) < 800").select("doc_id", "text"), odd.filter("text is null or length(text) < 5000").select("doc_id", "text")):
        rows = df.collect()
        plain = Deep([r.text for r in rows if not held(r.doc_id)], order)
        got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in scoring.score_documents(df, fold("doc_id") == 1, order=order).collect())
        wanted = sorted((str(r.doc_id), plain.base(r.text)[0], plain.score(r.text)) for r in rows)
        assert [g[:2] for g in got] == [w[:2] for w in wanted]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in wanted], rel=1e-5, abs=1e-4)
    assert scoring.score_documents(empty, fold("doc_id") == 1, order=order).count() == 0
    alone = scoring.score_documents(odd.limit(3), F.lit(True), order=order).collect()
    assert all(r.train_tokens == 0 and math.isfinite(r.score) for r in alone)


def test_the_query_learns_deeper_contexts(spark):
    documents, bits = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), {}
    rows = documents.select("doc_id", "text").collect()
    size = sum(len(r.text.encode()) + 1 for r in rows if held(r.doc_id))
    for name, found in (("two", scoring.score_documents(documents, fold("doc_id") == 1)), ("query", scoring.op7_score(spark, "/root/testdata/sf0.01"))):
        bits[name] = -found.filter("held_out").agg(F.sum("score")).first()[0] * math.log2(10) / size
    print(bits)  # bits a byte of held-out texts
    assert bits["query"] < bits["two"] - 0.2


@given(st.lists(st.integers(0, 2**48)))
def test_wide_numbers_come_back(values):
    assert scoring.unpack(scoring.pack(np.array(values, np.int64))).tolist() == values


@given(st.lists(st.integers(0, 2**28 - 1)))
def test_packed_numbers_come_back(values):
    assert scoring.unpack(scoring.pack(np.array(values, np.int64))).tolist() == values
