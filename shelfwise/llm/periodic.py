"""Runs of periodic words: stretches that repeat themselves at least twice.

A run is a stretch of words with smallest period q and a length of at least max(min_length, 2 q) that no
neighbouring word extends. Whole documents are searched, block by block, in tasks without a shuffle:

1. Frequency splitting. Every word of a run occurs in it at least twice, so a word that occurs once within its
   segment splits the segment. The words around a split are tested again within their smaller segment, to
   stability; only the smaller parts and the partners of their words are looked at, so a word is tested
   O(log n) times. Segments shorter than `min_length` go.
2. Lag scan of what survives. Short lags are compared over all words. A lag q in [2 b, 4 b) makes at least q
   consecutive matches, which contain a whole block of b words at a multiple of b; so only the lags at which
   such a block occurs again are followed, and the matches around it are extended by search over prefix
   hashes. Of the lags that give one stretch the smallest is its period.

Work is O(n log^2 n) in the words of a document, whatever it repeats. Words are compared by 64-bit hashes.

Defined results: words are `[^\\x20\\x09-\\x0D]+`, case counts; a null text is a text without words: no runs, empty
collapsed text; a null id is kept; repeated rows give a row each; an empty table gives no rows; other columns are
ignored. Memory of a task is that of 1 MB of text, or of its longest document: about 150 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import textbytes
from shelfwise.session import spread_out
from shelfwise.sources.tables import table

MIN_LENGTH = 12
# A longer document is cut into words piece by piece.
PIECE_BYTES = 1 << 22
PRIMES = (2_147_483_647, 2_147_483_629)


class Runs(NamedTuple):
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _word_table() -> np.ndarray:
    """Word bytes `[^\\x20\\x09-\\x0D]` map to themselves (NUL to 0xFF, no byte of UTF-8), white space to 0."""
    mapped = np.arange(256, dtype=np.uint8)
    mapped[0] = 0xFF
    mapped[[0x20, *range(0x09, 0x0E)]] = 0
    return mapped


def cut_words(data: np.ndarray, offsets: np.ndarray, piece: int = PIECE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, first) of the words of a block of texts."""
    mapped = _word_table()
    if len(data) <= piece or len(offsets) > 2:
        found = textbytes.words(data, offsets, mapped)
        return found.starts, found.ends, textbytes.word_hashes(found), found.first
    blank, parts, low = mapped[data] == 0, [], 0
    while low < len(data):
        high = min(low + piece, len(data))
        if high < len(data):  # up to the next white space
            ahead = int(np.argmax(blank[high:]))
            high = high + ahead if blank[high + ahead] else len(data)
        found = textbytes.words(data[low:high], np.array([0, high - low]), mapped)
        parts.append((found.starts + low, found.ends + low, textbytes.word_hashes(found)))
        low = high
    starts, ends, hashes = (np.concatenate(column) for column in zip(*parts))
    return starts, ends, hashes, np.array([0, len(starts)])


def neighbours(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the same word before and after each word of its document; -1 and the number of words if there is none."""
    n = len(words)
    with np.errstate(over="ignore"):
        keys = textbytes.mix(words + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    before, after = np.full(n, -1), np.full(n, n)
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the given spans, one after another."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def split_by_frequency(before: np.ndarray, after: np.ndarray, first: np.ndarray, min_length: int) -> np.ndarray:
    """Which words lie in a segment of `min_length` or more whose words all occur at least twice in it."""
    n = len(before)
    alive = np.ones(n, bool)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start, end = first[:-1].copy(), first[1:].copy()
    for short in np.flatnonzero((end - start < min_length) & (end > start)):
        alive[start[short] : end[short]] = False
    tested = np.flatnonzero(alive)
    while len(tested):
        own = owner[tested]
        rare = tested[(before[tested] < start[own]) & (after[tested] >= end[own])]
        if not len(rare):
            break
        alive[rare] = False
        # The parts of every split segment: between its start, its rare words and its end.
        split, at = np.unique(owner[rare], return_inverse=True)
        bounds = np.concatenate([start[split] - 1, rare, end[split]])
        of = np.concatenate([np.arange(len(split)), at, np.arange(len(split))])
        order = np.lexsort((bounds, of))
        bounds, of = bounds[order], of[order]
        inner = of[1:] == of[:-1]
        low, size, of = bounds[:-1][inner] + 1, (np.diff(bounds) - 1)[inner], of[:-1][inner]
        # The largest part keeps the segment's number.
        by_size = np.lexsort((-size, of))
        largest = np.zeros(len(of), bool)
        largest[by_size[np.append(True, of[by_size][1:] != of[by_size][:-1])]] = True
        start[split[of[largest]]], end[split[of[largest]]] = low[largest], (low + size)[largest]
        gone = largest & (size < min_length)
        alive[_spans(low[gone], size[gone])] = False
        low, size = low[~largest], size[~largest]
        places = _spans(low, size)
        owner[places] = np.repeat(np.arange(len(start), len(start) + len(low)), size)
        start, end = np.concatenate([start, low]), np.concatenate([end, low + size])
        alive[_spans(low[size < min_length], size[size < min_length])] = False
        partners = np.concatenate([before[places], after[places]])
        tested = np.unique(np.concatenate([places, partners[(partners >= 0) & (partners < n)]]))
        tested = tested[alive[tested]]
    return alive


class PrefixHash:
    """How far two places agree, by search over polynomial prefix hashes modulo two primes."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.parts = []
        for prime, base in zip(PRIMES, np.random.default_rng(0x9E3779).integers(1 << 20, 1 << 30, 2).tolist()):
            power = np.ones(len(words) + 1, np.int64)
            filled = 1
            while filled < len(power):  # base^i by doubling
                more = min(filled, len(power) - filled)
                power[filled : filled + more] = power[:more] * pow(base, filled, prime) % prime
                filled += more
            sums = np.zeros(len(words) + 1, np.int64)
            np.cumsum((words % np.uint64(prime)).astype(np.int64) * power[:-1] % prime, out=sums[1:])
            self.parts.append((prime, power, sums))

    def equal(self, place: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether `size` words from `place` equal those from `place + lag`."""
        same = np.ones(len(place), bool)
        for prime, power, sums in self.parts:
            here = (sums[place + size] - sums[place]) % prime
            there = (sums[place + lag + size] - sums[place + lag]) % prime
            same &= here * power[lag] % prime == there
        return same

    def reach(self, place: np.ndarray, lag: np.ndarray, most: np.ndarray, backwards: bool) -> np.ndarray:
        """Words from `place` on, or before it, that match at `lag`: at most `most`."""
        low, high = np.zeros(len(place), np.int64), most.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(place - middle if backwards else place, lag, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of the stretches of at least `least` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    start, size = edges[::2], edges[1::2] - edges[::2]
    return start[size >= least], size[size >= least]


def _returns(grams: np.ndarray, places: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, lag) of blocks at multiples of b that occur again at a lag in [2 b, 4 b), and the places of repeated blocks."""
    order = np.lexsort((places, grams))
    grams, places = grams[order], places[order]
    fresh = np.append(True, grams[1:] != grams[:-1]) if len(grams) else np.zeros(0, bool)
    group = np.cumsum(fresh) - 1
    repeated = np.bincount(group)[group] > 1 if len(group) else fresh
    group, places = group[repeated], places[repeated]
    anchor = places % b == 0
    width = int(places.max(initial=0)) + 4 * b + 1
    keyed = group * width + places
    low = np.searchsorted(keyed, keyed[anchor] + 2 * b)
    high = np.searchsorted(keyed, keyed[anchor] + 4 * b)
    at = np.repeat(places[anchor], high - low)
    return at, places[_spans(low, high - low)] - at, np.sort(places)


def lag_scan(words: np.ndarray, longest: int, min_length: int) -> Runs:
    """All runs of a sequence in which segments lie apart by unique words; `longest` is the size of the largest segment."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n, direct = len(words), min_length
    for lag in range(1, min(direct, longest // 2 + 1)):
        start, size = _stretches(words[lag:] == words[:-lag], max(lag, min_length - lag))
        found.append((start, start + size + lag, np.full(len(start), lag)))
    b = direct // 2
    if longest >= 4 * b and n > b:
        grams, places, prefix = textbytes.ngram_hashes(words, b), np.arange(n - b + 1), None
        while 4 * b <= longest:
            anchor, lag, repeated = _returns(grams[places], places, b)
            if not len(repeated):
                break
            if len(anchor):
                # Blocks one after another at one lag are one chain; it reaches less than a block further on either side.
                order = np.lexsort((anchor, lag))
                anchor, lag = anchor[order], lag[order]
                head = np.append(True, (lag[1:] != lag[:-1]) | (anchor[1:] != anchor[:-1] + b))
                tail = np.append(head[1:], True)
                low, high, lag = anchor[head], anchor[tail] + b, lag[head]
                useful = high - low + 2 * b > lag
                low, high, lag = low[useful], high[useful], lag[useful]
                prefix = prefix or PrefixHash(words)
                low = low - prefix.reach(low, lag, np.minimum(low, b), True)
                high = high + prefix.reach(high, lag, np.minimum(n - lag - high, b), False)
                long_ = high - low >= lag
                found.append((low[long_], (high + lag)[long_], lag[long_]))
            # A block of 2 b that occurs again starts and ends with blocks of b that do.
            held = np.zeros(n + 1, bool)
            held[repeated] = True
            places = repeated[held[np.minimum(repeated + b, n)]]
            doubled = np.zeros_like(grams)
            with np.errstate(over="ignore"):
                doubled[places] = textbytes.mix(grams[places] * np.uint64(0xD6E8FEB86659FD93) + grams[places + b])
            grams, b = doubled, 2 * b
    start, end, period = (np.concatenate(column) if found else np.zeros(0, np.int64) for column in (zip(*found) if found else ((), (), ())))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    smallest = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])) if len(start) else np.zeros(0, bool)
    start, end, period = start[smallest], end[smallest], period[smallest]
    order = np.lexsort((period, start))
    return Runs(start[order], (end - start)[order], period[order])


def find_runs(words: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[Runs, np.ndarray]:
    """The runs of a block of documents, and the document of each; `words[first[d]:first[d + 1]]` are those of document d."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    alive = split_by_frequency(*neighbours(words, doc), first, min_length)
    kept = np.flatnonzero(alive)
    if not len(kept):
        none = np.zeros(0, np.int64)
        return Runs(none, none, none), none
    # A unique word before every segment.
    border = np.append(True, (np.diff(kept) > 1) | (doc[kept[1:]] != doc[kept[:-1]]))
    place = np.arange(len(kept)) + np.cumsum(border)
    with np.errstate(over="ignore"):
        row = textbytes.mix(np.arange(len(kept) + int(border.sum()), dtype=np.uint64) + np.uint64(0xA5A5_5A5A_0000_0000))
    row[place] = words[kept]
    longest = int(np.diff(np.append(np.flatnonzero(border), len(kept))).max())
    found = lag_scan(row, longest, min_length)
    original = np.zeros(len(row), np.int64)
    original[place] = kept
    start = original[found.start]
    return Runs(start - first[doc[start]], found.length, found.period), doc[start]


def collapse(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the kept words of each text, joined by one space."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[keep]
    starts, ends = starts[keep], ends[keep]
    level = np.zeros(len(data) + 1, np.int8)
    level[starts] += 1
    level[ends] -= 1
    shown = np.cumsum(level[:-1], dtype=np.int8).astype(bool)
    joints = ends[:-1][doc[1:] == doc[:-1]]  # white space: another word of the text follows
    shown[joints] = True
    out = data.copy()
    out[joints] = 0x20
    sizes = np.zeros(len(data) + 1, np.int64)
    np.cumsum(shown, out=sizes[1:])
    return out[shown], sizes[offsets]


def _block(data: np.ndarray, offsets: np.ndarray, min_length: int) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs, their documents, words per document, and the collapsed texts of a block."""
    starts, ends, hashes, first = cut_words(data, offsets)
    runs, doc = find_runs(hashes, first, min_length)
    drop = np.zeros(len(starts) + 1, np.int64)
    np.add.at(drop, first[doc] + runs.start + runs.period, 1)
    np.add.at(drop, first[doc] + runs.start + runs.length, -1)
    text, cuts = collapse(data, offsets, starts, ends, first, np.cumsum(drop)[:-1] == 0)
    order = np.lexsort((runs.period, runs.start, doc))
    return Runs(*(part[order] for part in runs)), doc[order], np.diff(first), text, cuts


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per document: id, n_words, `runs` (start, length, period; by start, then period), `collapsed`.

    `collapsed` has the words joined by one space, without those that some run holds after its first period.
    `min_length` is even and at least 4.
    """
    run_type = pa.struct([(name, pa.int64()) for name in Runs._fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in textbytes.blocks(batch.column(1)):
                runs, doc, n_words, text, cuts = _block(data, offsets, min_length)
                listed = pa.StructArray.from_arrays([pa.array(part, pa.int64()) for part in runs], names=list(Runs._fields))
                runs_at = pa.array(np.searchsorted(doc, np.arange(high - low + 1)), pa.int32())
                collapsed = pa.LargeStringArray.from_buffers(high - low, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(text))
                columns = [
                    batch.column(0).slice(low, high - low), pa.array(n_words, pa.int64()),
                    pa.ListArray.from_arrays(runs_at, listed).cast(pa.list_(run_type)), collapsed.cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return spread_out(docs.select(F.col(id_col), F.col(text_col))).mapInArrow(run, schema)


def planted(id_col: str, text_col: str) -> Column:
    """The text, made periodic from some word on where crc32 of the id is divisible by 10."""
    mark = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(mark / 10)
    words = F.regexp_extract_all(text_col, F.lit(r"([^\x20\x09-\x0D]+)"))
    n = F.size(words).cast("bigint")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    block = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
    return F.when((mark % 10 == 0) & F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), changed).otherwise(F.col(text_col))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted("doc_id", "text").alias("text"))
    found = periodic_runs(docs)
    best = F.array_sort("runs", lambda x, y: F.when(x["length"] != y["length"], F.sign(y["length"] - x["length"]))
                        .when(x["start"] != y["start"], F.sign(x["start"] - y["start"])).otherwise(F.sign(x["period"] - y["period"])).cast("int"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", F.get(best, F.lit(0))).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in Runs._fields],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# crc32 of the decimal id, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""

QUERIES = {"op12_periodic_runs": op12_periodic_runs}
ORACLE = {
    "op12_periodic_runs": f"""
WITH b AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, {_CRC} AS h,
    coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w0 FROM documents),
a AS (SELECT *, len(w0) AS n, (h // 10) % greatest(len(w0), 1) AS a FROM b),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
d AS MATERIALIZED (
  SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w0[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w0 END AS w FROM p),
t AS MATERIALIZED (SELECT rid, n, unnest(w) AS word, unnest(range(n)) AS i FROM d),
e AS (
  SELECT x.rid, x.i, y.i - x.i AS q, x.i - row_number() OVER (PARTITION BY x.rid, y.i - x.i ORDER BY x.i) AS g
  FROM t x JOIN t y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 2),
s AS (SELECT rid, q, min(i) AS start, count(*) + q AS length FROM e GROUP BY rid, q, g HAVING count(*) >= greatest(q, 12 - q)),
r AS MATERIALIZED (SELECT rid, start, length, min(q) AS period FROM s GROUP BY rid, start, length),
k AS (
  SELECT t.rid, t.i, t.word FROM t
  WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.rid = t.rid AND t.i >= r.start + r.period AND t.i < r.start + r.length)),
c AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS collapsed FROM k GROUP BY rid),
m AS (
  SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    first(struct_pack(start := start, length := length, period := period) ORDER BY length DESC, start, period) AS best
  FROM r GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.period::BIGINT AS period,
  (1000 * best.length // best.period)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN m USING (rid) LEFT JOIN c USING (rid)
"""
}
