"""The most frequent words over any range of days, from small summaries that are stored per day.

A summary (Misra-Gries) keeps at most `counters` words of what one task read of a day; each count is too low by
`error` at most. Summaries add up: over a range, a word's count lies between the sum of its counts and that sum plus
the sum of the errors, and a word in no summary occurs at most so many times as the errors add up to. That leaves few
candidates for the top k, which are counted exactly in a second pass over the range. If the errors are too large to
rule out words in no summary, all words of the range are counted instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.session import fits, materialize
from shelfwise.sources.files import replace_partitions

COUNTERS = 4096


class Summary:
    """Counts of the most frequent words of a stream, each too low by `error` at most."""

    def __init__(self, counters: int):
        self.counters, self.words, self.counts, self.error, self.total = counters, pa.array([], pa.string()), np.zeros(0, np.int64), 0, 0

    def add(self, words: pa.Array, counts: np.ndarray | None = None, error: int = 0) -> None:
        coded = pa.concat_arrays([self.words, words.cast(pa.string())]).dictionary_encode()
        each = np.concatenate([self.counts, np.ones(len(words), np.int64) if counts is None else counts])
        summed = np.bincount(coded.indices.to_numpy(), weights=each, minlength=len(coded.dictionary)).astype(np.int64)
        self.total += int(each[len(self.counts) :].sum())
        cut = int(np.partition(summed, -self.counters - 1)[-self.counters - 1]) if len(summed) > self.counters else 0
        kept = np.flatnonzero(summed > cut)
        self.words, self.counts, self.error = coded.dictionary.take(pa.array(kept)), summed[kept] - cut, self.error + cut + error


def summarise(rows: DataFrame, day: str, word: str, counters: int = COUNTERS) -> DataFrame:
    """(day, words, counts, error, total): one summary per task and day; `rows` has a word per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, Summary] = {}
        for batch in batches:
            days = batch["day"].dictionary_encode()
            codes = days.indices.fill_null(len(days.dictionary)).to_numpy()
            for code in np.unique(codes):
                name = days.dictionary[int(code)].as_py() if code < len(days.dictionary) else None
                held.setdefault(name, Summary(counters)).add(batch["word"].filter(pa.array(codes == code)))
        for name, s in held.items():
            lists = [pa.array([s.words.to_pylist()], pa.list_(pa.string())), pa.array([s.counts.tolist()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), *lists, pa.array([s.error], pa.int64()), pa.array([s.total], pa.int64())],
                                             names=["day", "words", "counts", "error", "total"])

    named = rows.select(F.col(day).alias("day"), F.col(word).alias("word")).filter("word IS NOT NULL")
    return named.mapInArrow(run, "day string, words array<string>, counts array<bigint>, error bigint, total bigint")


def store_days(rows: DataFrame, day: str, word: str, path: str, counters: int = COUNTERS) -> None:
    """Put the summaries of the days in `rows` in place of older ones of those days."""
    replace_partitions(summarise(rows, day, word, counters), path, "day")


def between(df: DataFrame, day: str, first: str, last: str) -> DataFrame:
    return df.filter(F.col(day).between(first, last))


def candidates(summaries: DataFrame, k: int) -> tuple[DataFrame, bool]:
    """(word, least) of all words that may be among the k most frequent, and whether no other word can be."""
    whole = materialize(summaries.select(F.explode(F.arrays_zip("words", "counts")).alias("e")).groupBy(F.col("e.words").alias("word")).agg(F.sum("e.counts").alias("least")), "merged")
    error = summaries.agg(F.coalesce(F.sum("error"), F.lit(0))).first()[0]
    leading = [row.least for row in whole.select("least").orderBy(F.desc("least")).limit(k).collect()]
    kth = leading[-1] if len(leading) == k else 0
    return whole.filter(F.col("least") + error >= kth), error == 0 or error < kth


def most_frequent(rows: DataFrame, summaries: DataFrame, day: str, word: str, first: str, last: str, k: int = 10) -> DataFrame:
    """(word, n, rank): the k most frequent words of the days from `first` to `last`, exactly; ties in order of the word."""
    likely, complete = candidates(between(summaries, "day", first, last), k)
    inside = between(rows, day, first, last).select(F.col(word).alias("word")).filter("word IS NOT NULL")
    if complete:
        named = likely.select("word")
        inside = inside.join(F.broadcast(named) if fits(named) else named, "word", "left_semi")
    counted = inside.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    best = counted.orderBy(F.desc("n"), "word").limit(k)  # a top-k
    return best.withColumn("rank", F.row_number().over(W.orderBy(F.desc("n"), "word")))
