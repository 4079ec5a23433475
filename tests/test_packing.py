"""Packing hits into a budget against a plain version."""

from __future__ import annotations

import math
import random

from shelfwise.operators import rag


def plain(hits, budget, frame):
    out, total = [], 0
    for h in sorted(hits, key=lambda h: h[1]):
        _, rank, source, ordinal, start, text = h
        stop = start + len(text)
        shared = sum(
            max(0, min(stop, o[4] + len(o[5])) - max(start, o[4]))
            for o in hits if o[2] == source and abs(o[3] - ordinal) == 1 and o[1] < rank
        )
        tokens = math.ceil(max(len(text) - shared, 0) / 4) + frame
        total += tokens
        out.append((rank, tokens, total, total <= budget))
    return out


def test_packing_counts_overlaps_once(spark):
    rng = random.Random(5)
    hits = []
    for q in range(6):
        places = rng.sample([(s, o) for s in "ab" for o in range(6)], 7)
        hits += [(q, rank + 1, s, o, 40 * o, "x" * rng.choice((40, 50, 55))) for rank, (s, o) in enumerate(places)]
    df = spark.createDataFrame(hits, "question_id long, rank int, source string, ordinal int, start int, text string")
    for budget, frame in ((60, 3), (10_000, 0), (0, 0)):
        got = {}
        for r in rag.pack_context(df, budget, frame).orderBy("question_id", "rank").collect():
            got.setdefault(r.question_id, []).append((r.rank, r.tokens, r.total, r.packed))
        assert got == {q: plain([h for h in hits if h[0] == q], budget, frame) for q in range(6)}
