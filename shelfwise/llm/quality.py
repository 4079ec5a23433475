"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of whole texts (shares of symbols, upper case, digits, repeated words, ...) come from one narrow
numpy pass. On a bounded sample of labelled rows, small boosted trees are grown; every path of a tree is a
rule, a conjunction of comparisons; a lasso logistic regression over the rules keeps few of them. The kept
rules are compiled to a Spark column expression, so scoring is that pass and an expression, without a shuffle.

The only bound is `sample` labelled rows for fitting, chosen by the hash of their ids; every document is scored.

Defined results: a null or empty text has all statistics 0 and gets a score like any other; labels that are null
are not learned from; several labels of one document are several examples; without labels, or with one kind
only, the score is the smoothed share of label 1; an empty table gives no rows; other columns pass through
`keep_good` and are ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import textbytes
from shelfwise.llm.folds import fold
from shelfwise.session import spread_out
from shelfwise.sources.tables import table

SAMPLE = 20_000
THRESHOLD = 0.3
STATISTICS = (
    "n_chars", "n_words", "word_bytes", "longest_word", "short_words", "upper", "digits", "stops", "symbols", "wide",
    "lines_per_word", "repeated", "distinct", "commonest",
)
_STRUCT = "struct<" + ",".join(f"{name}:double" for name in STATISTICS) + ">"

TREES, DEPTH, CUTS, RATE = 40, 3, 32, 0.3
LASSO, STEPS = 0.002, 400


def _class_table() -> np.ndarray:
    """Byte classes: 1 upper, 2 digit, 3 sentence marks, 4 other ASCII signs, 5 newline, 6 first byte of a non-ASCII character."""
    classes = np.zeros(256, np.uint8)
    classes[ord("A") : ord("Z") + 1] = 1
    classes[ord("0") : ord("9") + 1] = 2
    for mark in ".,;:?'\"()-":
        classes[ord(mark)] = 3
    for low, high in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)):
        for code in range(low, high):
            classes[code] = classes[code] or 4
    classes[ord("\n")] = 5
    classes[0xC0:] = 6
    return classes


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags in each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of `STATISTICS` per text."""
    classes, mapped = _class_table(), textbytes.nonspace_table()
    out = [np.empty((0, len(STATISTICS)))]
    for _, _, data, offsets in textbytes.blocks(texts):
        found = textbytes.words(data, offsets, mapped)
        hashes, sizes = textbytes.word_hashes(found), found.ends - found.starts
        n = np.diff(found.first)
        doc = np.repeat(np.arange(len(n)), n)
        kinds = classes[data]
        full = _per_text(found.data != 0, offsets)
        same = np.zeros(len(hashes), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
        order = np.lexsort((hashes, doc))
        first = np.ones(len(order), bool)
        first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        runs = np.diff(np.append(np.flatnonzero(first), len(order)))
        commonest, longest = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        np.maximum.at(commonest, doc[order][first], runs)
        np.maximum.at(longest, doc, sizes)
        words, filled = np.maximum(n, 1), np.maximum(full, 1)
        out.append(
            np.stack(
                [
                    _per_text((data & 0xC0) != 0x80, offsets), n, full / words, longest, np.bincount(doc, sizes <= 2, len(n)) / words,
                    *[_per_text(kinds == kind, offsets) / filled for kind in (1, 2, 3, 4, 6)],
                    _per_text(kinds == 5, offsets) / words, np.bincount(doc, same, len(n)) / words,
                    np.bincount(doc[order][first], minlength=len(n)) / words, commonest / words,
                ],
                axis=1,
            ).astype(np.float64)
        )
    return np.concatenate(out)


def with_statistics(docs: DataFrame, text_col: str, keep: list[str], name: str = "_statistics") -> DataFrame:
    """The columns to keep, and the statistics of each whole text as one struct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics(batch.column(batch.num_columns - 1))
            struct = pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(len(STATISTICS))], names=list(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], struct], names=[*batch.schema.names[:-1], name])

    kept = docs.select(*keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + [f"{name} {_STRUCT}"])
    return spread_out(docs.select(*keep, F.col(text_col).alias(f"{name}_text"))).mapInArrow(run, schema)


class Rule(NamedTuple):
    """All of (statistic, above, cut): the statistic is > cut if above, else <= cut."""

    parts: tuple[tuple[int, bool, float], ...]

    def holds(self, rows: np.ndarray) -> np.ndarray:
        return np.logical_and.reduce([(rows[:, s] > cut) == above for s, above, cut in self.parts])

    def column(self, struct: str) -> Column:
        tests = [F.col(f"{struct}.{STATISTICS[s]}") > cut if above else F.col(f"{struct}.{STATISTICS[s]}") <= cut for s, above, cut in self.parts]
        return reduce(lambda a, b: a & b, tests)


class Ensemble(NamedTuple):
    intercept: float
    rules: list[tuple[Rule, float]]

    def column(self, struct: str = "_statistics") -> Column:
        """Score between 0 and 1 as a Spark expression."""
        terms = [F.when(rule.column(struct), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.rules]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(self.intercept))))


def _grow(bins: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, rows: np.ndarray, features: np.ndarray):
    """One tree on gradients: its paths as rules, and the step of each row that reaches a leaf."""
    rules, steps = [], np.zeros(len(slope))
    stack = [(rows, (), 0)]
    while stack:
        own, path, depth = stack.pop()
        total, weight = slope[own].sum(), curve[own].sum()
        best = (1e-6, None)
        for s in features if depth < DEPTH else ():
            g = np.bincount(bins[own, s], slope[own], CUTS + 1).cumsum()[:-1]
            h = np.bincount(bins[own, s], curve[own], CUTS + 1).cumsum()[:-1]
            n = np.bincount(bins[own, s], minlength=CUTS + 1).cumsum()[:-1]
            gain = g**2 / (h + 1) + (total - g) ** 2 / (weight - h + 1) - total**2 / (weight + 1)
            gain = np.where((n >= 5) & (len(own) - n >= 5), gain, 0)[: len(cuts[s])]
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), (s, int(gain.argmax())))
        if path:
            rules.append(Rule(path))
        if best[1] is None:
            steps[own] = total / (weight + 1)
            continue
        s, place = best[1]
        above = bins[own, s] > place
        stack += [(own[side], (*path, (int(s), up, float(cuts[s][place]))), depth + 1) for side, up in ((above, True), (~above, False))]
    return rules, steps


def grow_rules(rows: np.ndarray, labels: np.ndarray, seed: int = 5) -> list[Rule]:
    """Paths of boosted trees, each on half of the rows and half of the statistics."""
    random = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(rows[:, s], np.linspace(0, 1, CUTS + 1)[1:-1], method="lower")) for s in range(rows.shape[1])]
    bins = np.stack([np.searchsorted(cuts[s], rows[:, s], "left") for s in range(rows.shape[1])], axis=1)
    share = (labels.sum() + 1) / (len(labels) + 2)
    margin, rules = np.full(len(labels), np.log(share / (1 - share))), {}
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-margin))
        picked = random.permutation(len(rows))[: max(10, len(rows) // 2)]
        features = random.permutation(rows.shape[1])[: rows.shape[1] // 2]
        found, _ = _grow(bins, cuts, labels - chance, chance * (1 - chance), picked, features)
        rules.update(dict.fromkeys(found))
        leaves, step = _grow(bins, cuts, labels - chance, chance * (1 - chance), np.arange(len(rows)), features)
        rules.update(dict.fromkeys(leaves))
        margin = margin + RATE * step
    return list(rules)


def lasso(matrix: np.ndarray, labels: np.ndarray, penalty: float = LASSO, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Logistic weights with an L1 penalty (accelerated proximal gradient); the intercept is free."""
    n, m = matrix.shape
    x = np.concatenate([matrix, np.ones((n, 1))], axis=1)
    vector = np.ones(m + 1)
    for _ in range(20):  # largest eigenvalue, for the step size
        vector = x.T @ (x @ vector)
        vector /= np.linalg.norm(vector)
    rate = 4 * n / max(float(np.linalg.norm(x.T @ (x @ vector))), 1e-12)
    weights = ahead = np.zeros(m + 1)
    for k in range(steps):
        slope = x.T @ (1 / (1 + np.exp(-(x @ ahead))) - labels) / n
        moved = ahead - rate * slope
        moved[:-1] = np.sign(moved[:-1]) * np.maximum(np.abs(moved[:-1]) - rate * penalty, 0)
        ahead = moved + k / (k + 3) * (moved - weights)
        weights = moved
    return float(weights[-1]), weights[:-1]


def fit(rows: np.ndarray, labels: np.ndarray) -> Ensemble:
    """Rules and weights of a sample of statistics and 0/1 labels."""
    positive = float(labels.sum())
    if not len(labels) or positive in (0.0, float(len(labels))):
        return Ensemble(float(np.log((positive + 1) / (len(labels) - positive + 1))), [])
    rules = grow_rules(rows, labels)
    if not rules:
        return Ensemble(float(np.log((positive + 1) / (len(labels) - positive + 1))), [])
    intercept, weights = lasso(np.stack([r.holds(rows) for r in rules], axis=1).astype(np.float64), labels)
    return Ensemble(intercept, [(r, float(w)) for r, w in zip(rules, weights) if w])


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> Ensemble:
    """Fit on at most `sample` labelled rows for which `usable` (over the label table) holds."""
    picked = labels.filter(usable).filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    picked = picked.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_label"))
    picked = picked.orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample)
    picked = picked.groupBy("_id", "_label").agg(F.count(F.lit(1)).cast("int").alias("_times"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    known = rows.join(F.broadcast(picked), "_id")  # at most `sample` rows of two numbers
    known = known.groupBy("_id", "_label", "_times").agg(F.min("_text").alias("_text"))  # rows that repeat an id add none
    known = known.withColumn("_times", F.explode(F.array_repeat(F.lit(1), F.col("_times"))))
    found = with_statistics(known, "_text", ["_id", "_label"]).select("_id", "_label", "_statistics.*").toPandas()
    found = found.sort_values(["_id", "_label", *STATISTICS])
    return fit(found[list(STATISTICS)].to_numpy(np.float64).reshape(-1, len(STATISTICS)), found["_label"].to_numpy(np.float64))


def score(docs: DataFrame, model: Ensemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    return with_statistics(docs, text_col, [id_col]).select(id_col, model.column().alias("score"))


def keep_good(docs: DataFrame, model: Ensemble, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Documents that score at least `threshold`, all columns as they are."""
    return with_statistics(docs, text_col, docs.columns).filter(model.column() >= threshold).select(*docs.columns)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), fold("doc_id") != 0)
    return score(docs, model).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


QUERIES = {"op5_quality": op5_quality}
ORACLE: dict[str, str] = {}
