from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from shelfwise.llm import decontaminate, mixing, neardup, quality, sharding
from shelfwise.llm.folds import fold
from shelfwise.session import materialize
from test_mixing import water
from test_neardup import brute

SF = "/root/testdata/sf0.001"


def plain_mix(docs):
    """Copies of each row by sorting every source."""
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
    totals = Counter()
    for d in docs:
        totals[d.source] += size[d.doc_id]
    names = sorted(totals)
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    targets = water(totals, weights, mixing.EPOCHS * sum(totals.values()), mixing.MAX_EPOCHS)
    out = []
    for source in names:
        whole = math.floor(targets[source] / totals[source])
        rest, before = targets[source] - whole * totals[source], 0
        own = [d for d in docs if d.source == source]
        for d in sorted(own, key=lambda d: hashlib.md5(f"{mixing.SEED}:{d.doc_id}".encode()).hexdigest()):
            once_more = size[d.doc_id] > 0 and 2 * before + size[d.doc_id] <= 2 * rest
            out += [d.doc_id] * (whole + once_more)
            before += size[d.doc_id]
    return sorted(out)


def test_pipeline_equals_a_plain_version(spark, documents):
    steps, docs = {}, documents
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        steps[name] = docs
        assert docs.columns[: len(documents.columns)] == documents.columns
    rows = {name: df.collect() for name, df in steps.items()}

    model = quality.train(documents, spark.read.parquet(f"{SF}/labels.parquet"), fold("doc_id") != 0)
    stats = quality.with_statistics(documents, "text", ["doc_id"]).select("doc_id", "_statistics.*").toPandas().sort_values("doc_id")
    values = stats[list(quality.STATISTICS)].to_numpy()
    margin = model.intercept + sum(w * rule.holds(values) for rule, w in model.rules)
    assert sorted(r.doc_id for r in rows["quality"]) == stats.doc_id[1 / (1 + math.e ** -margin) >= quality.THRESHOLD].tolist()

    classes = brute([(r.doc_id, r.text) for r in rows["quality"]])
    assert sorted(r.doc_id for r in rows["neardup"]) == sorted({c[1] for c in classes})

    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in rows["neardup"] if not decontaminate.reference_scan(r.text, items)[4]]
    assert sorted(r.doc_id for r in rows["decontaminate"]) == sorted(clean) and len(clean) < len(rows["neardup"])

    assert sorted(r.doc_id for r in rows["mix"]) == plain_mix(rows["decontaminate"])
    texts = {r.doc_id: r for r in documents.collect()}
    assert all(r == texts[r.doc_id] for r in rows["mix"])

    assert sorted(r.doc_id for r in rows["shard"]) == sorted(r.doc_id for r in rows["mix"])
    order = [(r.curve, r.doc_id) for r in sorted(rows["shard"], key=lambda r: (r.shard, r.curve, r.doc_id))]
    assert order == sorted(order) and {r.shard for r in rows["shard"]} == set(range(sharding.SHARDS))
    counts = Counter(r.shard for r in rows["shard"])
    assert max(counts.values()) - min(counts.values()) <= 4  # equal rows stay together


def test_odd_and_empty_tables(spark, odd, empty):
    for docs, fewest in ((odd, 1), (empty, 0)):
        columns = docs.columns
        for name, stage in pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF), f"odd-{name}")
            assert docs.columns[: len(columns)] == columns
        assert docs.count() >= fewest
    assert neardup.choose_bands(0.8)[0] > 1


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert names["pipeline"] is pipeline.run
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10


@pytest.mark.parametrize("key", ["op1_chat_format", "op2_jaccard_join", "op3_decontaminate", "op4_exact_topk", "op8_mix_sources"])
def test_queries_match_sql(spark, key):
    import __spark_entry__ as entry
    import check

    df = entry.queries()[key](spark, SF)
    cursor = check.duck(SF).execute(entry.oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    assert check.compare(df.columns, [tuple(r) for r in df.collect()], names, cursor.fetchall()) is None
