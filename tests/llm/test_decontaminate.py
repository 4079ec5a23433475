from __future__ import annotations

import hashlib

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import decontaminate as dec

WORDS = st.lists(st.sampled_from(["a", "b", "c", "dd", "é"]), max_size=60)


def compiled(items):
    return dec.compile_patterns([(i, t) for i, t in items if t is not None])


def digest(found):
    n, spans, items = found
    ids = sorted(i for i in items if i is not None)
    return n, sum(e - s for s, e in spans), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(spans)


@settings(max_examples=60, deadline=None)
@given(st.lists(WORDS, max_size=6), st.lists(WORDS, min_size=1, max_size=5))
def test_scan_equals_plain_search(texts, patterns):
    items = [(str(i), " ".join(words)) for i, words in enumerate(patterns)]
    texts = [", ".join(words) for words in texts]
    found = dec.scan(pa.array(texts, pa.string()), compiled(items))
    assert [digest(f) for f in found] == [dec.reference_scan(t, items) for t in texts]


def test_lanes_meet_without_gaps():
    """A passage is found wherever it lies in a text of many lanes."""
    passage = [f"p{i}" for i in range(12)]
    groups = compiled([("x", " ".join(passage))])
    for at in (0, 1, dec.LANE - 9, dec.LANE - 1, dec.LANE, 3 * dec.LANE + 5, 1000):
        words = [f"w{i}" for i in range(1000)]
        words[at:at] = passage
        ((n, spans, items),) = dec.scan(pa.array([" ".join(words)]), groups)
        assert (n, spans, items) == (1012, [(at, at + 12)], {"x"})


def test_short_and_wordless_items():
    groups = compiled([("s", "Two words"), ("e", ""), ("n", None), (None, "no id")])
    texts = ["has two, WORDS here", "two three words", "no id", None, ""]
    found = dec.scan(pa.array(texts), groups)
    assert [(n, spans, sorted(map(str, items))) for n, spans, items in found] == [
        (4, [(1, 3)], ["s"]), (3, [], []), (2, [(0, 2)], ["None"]), (0, [], []), (0, [], []),
    ]


def test_slabs_do_not_change_the_result(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = dec.find_contamination(documents, items).collect()
    slabbed = dec.find_contamination(documents, items, slab_words=300)
    assert sorted(one) == sorted(slabbed.collect())
    assert any(r.spans for r in one)
    kept = dec.drop_contaminated(documents, items, slab_words=300).collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in one if not r.spans)
    # However many slabs there are, the plan has one Python stage.
    assert len(list(dec.pattern_slabs(items, "item_id", "text", 300))) > 3
    assert slabbed._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_slabs_pass_over_held_batches(monkeypatch):
    """Batches are held up to a size, in order; one slab is compiled at a time."""
    items = [[("a", "one two three")], [("b", "two three four"), (None, "five")], []]
    compiled_slabs = []
    compile_patterns = dec.compile_patterns
    monkeypatch.setattr(dec, "compile_patterns", lambda rows: compiled_slabs.append(rows) or compile_patterns(rows))

    class Shared:
        def __init__(self, rows):
            self.value = dec.zlib.compress(dec.pickle.dumps(rows))

    texts = [["one two three four"], ["x five", None], [], ["two three four", "one two"]]
    batches = [pa.RecordBatch.from_arrays([pa.array(t, pa.string())], names=["text"]) for t in texts]
    wanted = [[(4, [(0, 4)], {"a", "b"})], [(2, [(1, 2)], {None}), (0, [], set())], [], [(3, [(0, 3)], {"b"}), (2, [], set())]]
    for hold, rounds in ((1 << 30, 1), (1, 3)):
        monkeypatch.setattr(dec, "HOLD_BYTES", hold)
        compiled_slabs.clear()
        found = list(dec.Slabs([Shared(rows) for rows in items]).scan_batches(iter(batches), 0))
        assert [b.num_rows for b, _ in found] == [len(t) for t in texts] and [f for _, f in found] == wanted
        assert compiled_slabs == items * rounds


def test_equal_benchmark_rows_are_one(spark):
    rows = [(1, "one two three four five")] * 400 + [(i, f"row {i} of the benchmark is here") for i in range(2, 50)]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    slabs = list(dec.pattern_slabs(items, "item_id", "text", 100))
    assert sorted(r for slab in slabs for r in slab) == sorted((str(i), t) for i, t in set(rows))


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame(
        [(1, "three four five six seven eight nine ten eleven twelve"), (2, "two three four five six seven eight nine ten eleven"), (None, "hi"), (3, None), (2, "hi")],
        "item_id bigint, text string",
    )
    found = dec.find_contamination(odd, items).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == odd.count()
    assert by_id[1].items == by_id[2].items == ["2"] and [tuple(s) for s in by_id[1].spans] == [(1, 11)]
    assert by_id[10].items == ["2"] and by_id[10].unnamed and by_id[8].n_words == 300_000
    assert by_id[3].n_words == by_id[4].n_words == by_id[6].n_words == 0
    kept = dec.drop_contaminated(odd, items)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 3, 4, 5, 6, 7, 8, 9]
    assert dec.find_contamination(empty, items).count() == 0 and dec.drop_contaminated(empty, items).count() == 0
    assert dec.drop_contaminated(odd, items.limit(0)).count() == odd.count()
