from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from shelfwise.llm import periodic, textbytes

WORDS = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(words, min_length=12):
    """Every lag over the whole text; the smallest lag of each stretch."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapse(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def text_of(kind, rng):
    letters = "abc" if kind % 3 == 0 else [f"w{i}" for i in range(40)]
    words = [rng.choice(letters) for _ in range(rng.randint(0, 150))]
    for _ in range(rng.randint(0, 4)):
        block = [rng.choice(letters) for _ in range(rng.randint(1, 40))]
        if kind % 2:  # a run inside a run
            block = block[: len(block) // 2] * 3 + ["x"]
        at = rng.randint(0, len(words))
        words[at:at] = (block * rng.randint(2, 6))[: rng.randint(1, 400)]
    return words


def kernel(texts):
    table = [" ".join(t) for t in texts]
    data = np.frombuffer("".join(table).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in table])]).astype(np.int64)
    runs, doc, n, text, cuts = periodic._block(data, offsets, 12)
    out = []
    for d in range(len(texts)):
        own = doc == d
        out.append((
            sorted(zip(runs.start[own].tolist(), runs.length[own].tolist(), runs.period[own].tolist())),
            text[cuts[d] : cuts[d + 1]].tobytes().decode(),
        ))
    return out


@pytest.mark.parametrize("seed", range(8))
def test_equals_brute_force(seed):
    rng = random.Random(seed)
    texts = [text_of(k, rng) for k in range(60)]
    for words, (runs, collapsed) in zip(texts, kernel(texts)):
        assert runs == brute_runs(words)
        assert collapsed == brute_collapse(words, runs)


def test_words_that_repeat_without_a_period():
    """Fibonacci and Thue-Morse words hold many runs, and runs inside runs."""
    a, b = ["a"], ["a", "b"]
    while len(b) < 600:
        a, b = b, b + a
    thue = ["ab"[bin(i).count("1") % 2] for i in range(512)]
    for words in (b, thue, ["a"] * 300, (["a"] * 50 + ["b"]) * 6, ["a", "b"] * 7 + ["b", "a"] * 7):
        assert kernel([words])[0][0] == brute_runs(words)


def test_splitting_reaches_the_same_words_as_counting_anew():
    rng = np.random.default_rng(3)
    for _ in range(40):
        sizes = rng.integers(0, 200, 5)
        first = np.concatenate([[0], np.cumsum(sizes)])
        words = rng.integers(0, rng.integers(2, 60), first[-1])
        wanted = np.zeros(len(words), bool)
        stack = [(int(a), int(b)) for a, b in zip(first[:-1], first[1:])]
        while stack:
            low, high = stack.pop()
            if high - low < 12:
                continue
            values, count = np.unique(words[low:high], return_counts=True)
            rare = low + np.flatnonzero(np.isin(words[low:high], values[count < 2]))
            if len(rare):
                edges = [low - 1, *rare.tolist(), high]
                stack += [(x + 1, y) for x, y in zip(edges[:-1], edges[1:])]
            else:
                wanted[low:high] = True
        doc = np.repeat(np.arange(5), sizes)
        hashes = textbytes.mix(words.astype(np.uint64) + np.uint64(1))
        before, after = periodic.neighbours(hashes, doc)
        assert (periodic.split_by_frequency(before, after, first, 12) == wanted).all()


def test_long_texts_stay_near_linear():
    chain = [f"u{i // 2 if i % 2 else i // 2 + 3}" for i in range(200_000)]  # loses a word a round
    same = ["a"] * 300_000
    assert kernel([chain])[0][0] == []
    assert kernel([same])[0] == ([(0, 300_000, 1)], "a")


def test_words_cut_by_pieces():
    text = ("alpha bb  \n gamma\x00x żółć " * 2000).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole, pieces = periodic.cut_words(data, offsets), periodic.cut_words(data, offsets, 1000)
    assert all((a == b).all() for a, b in zip(whole, pieces))
    one = np.frombuffer(b"x" * 5000, np.uint8)
    assert periodic.cut_words(one, np.array([0, 5000]), 1000)[1].tolist() == [5000]


def test_odd_rows(spark, odd, empty):
    found = periodic.periodic_runs(odd).collect()
    texts = odd.select("doc_id", "text").collect()
    assert sorted((str(r.doc_id), r.n_words) for r in found) == sorted((str(r.doc_id), len(WORDS.findall(r.text or ""))) for r in texts)
    for r in found:
        if r.doc_id == 8:
            assert [tuple(x) for x in r.runs] == [(0, 300_000, 10)]
            assert r.collapsed == "alpha beta gamma delta epsilon zeta eta theta iota kappa"
        else:
            assert r.runs == []
    assert periodic.periodic_runs(empty).collect() == []
    by_name = periodic.periodic_runs(odd, "key", "text")
    assert by_name.columns == ["key", "n_words", "runs", "collapsed"] and by_name.count() == odd.count()


def test_query_equals_a_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r.asDict() for r in periodic.op12_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc in docs:
        words = WORDS.findall(doc.text or "")
        n, h = len(words), zlib.crc32(str(doc.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 1500:  # the plain search is quadratic
            continue
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert got[doc.doc_id] == {
            "doc_id": doc.doc_id, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(brute_collapse(words, runs).encode()).hexdigest(),
        }


def test_null_ids_are_not_made_periodic(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None), (0, None)], "doc_id bigint, text string")
    assert sorted(map(str, (r.t for r in df.select(periodic.planted("doc_id", "text").alias("t")).collect()))) == ["None", "None", "a b"]
