from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.llm import token_counts as tc

PIECES = st.sampled_from(["a", "b", "'", "s", "re", "'ll", " ", "  ", "\n", "\n\n", "\t", "1", "23", "!", "é", "日本", "x y", "The", ".", " '"])
TEXT = st.lists(PIECES, max_size=300).map("".join)


@settings(max_examples=150, deadline=None)
@given(TEXT, st.lists(st.tuples(st.floats(0, 1), st.floats(0, 1), st.lists(PIECES, max_size=15).map("".join)), max_size=6))
def test_edited_trees_equal_fresh_ones(text, edits):
    own = tc.tokenizer()
    tree = tc.TokenTree(own, text)
    for a, b, new in edits:
        start, end = sorted((int(a * len(text)), int(b * len(text))))
        tree.edit(start, end, new)
        text = text[:start] + new + text[end:]
        assert tree.text() == text and tree.n_chars == len(text)
        assert tree.leaves()[0] == [len(p) for p in own.cut(text)]
        assert tree.n_tokens == len(own.encoding.encode_ordinary(text))


def test_an_edit_encodes_only_its_surroundings():
    own = tc.tokenizer()
    text = "The quick brown fox jumps over the lazy dog. " * 20_000
    tree = tc.TokenTree(own, text)
    tree.encoded = 0
    tree.edit(450_000, 450_003, "cat")
    assert tree.encoded < 20
    changed = text[:450_000] + "cat" + text[450_003:]
    assert tree.n_tokens == len(own.encoding.encode_ordinary(changed))


def test_query_equals_encoding_the_edited_text(spark, documents):
    trees = tc.with_redactions(tc.build_trees(documents))
    own = tc.tokenizer()
    for r, edited in zip(sorted(trees.collect()), sorted(tc.apply_edits(trees).collect())):
        text = r.text
        for e in sorted(r.edits, key=lambda e: e.start, reverse=True):
            text = text[: e.start] + e.text + text[e.end :]
        assert edited.text == text and edited.n_tokens == len(own.encoding.encode_ordinary(r.text))
        assert edited.n_edited == len(own.encoding.encode_ordinary(text)) == sum(edited.tokens)


def test_odd_rows(spark, odd, empty):
    trees = tc.build_trees(odd)
    kind = "array<struct<start:int,end:int,text:string>>"
    assert tc.apply_edits(trees.withColumn("edits", F.lit(None).cast(kind))).filter("n_tokens <> n_edited").count() == 0
    edits = F.array(F.struct(F.lit(-5).alias("start"), F.lit(None).cast("int").alias("end"), F.lit("ab").alias("text")),
                    F.struct(F.lit(10**9).alias("start"), F.lit(10**9).alias("end"), F.lit(None).cast("string").alias("text")))
    rows = tc.apply_edits(trees.withColumn("edits", edits)).collect()
    texts = sorted((r.text or "") for r in odd.collect())
    assert sorted(r.text[2:] for r in rows) == texts and all(r.text.startswith("ab") for r in rows)
    assert tc.apply_edits(tc.with_redactions(tc.build_trees(empty))).count() == 0
