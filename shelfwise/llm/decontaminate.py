"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of ten consecutive words of the benchmark items; an item of fewer words is one
window. Patterns of one length m form a class. Per class, the block of the last `block` words of a search
window is looked up in a shift table: the smallest distance from that block to the end of any pattern, so
positions that no pattern can reach are skipped. A shift of zero leads to the bucket of patterns that end
in this block; these are compared word by word with the text.

Search windows of all texts of an Arrow batch advance together in numpy: texts are cut in lanes that
overlap by m - 1 words, each lane has a position, and one step moves every lane by its own shift.

The scan is narrow: no text is shuffled. Patterns go to the tasks in slabs of about `slab_words` words, as
compressed text. One Python worker takes the slabs in turn for every HOLD_BYTES of documents and keeps one
compiled slab at a time, so a benchmark of many slabs costs time, not memory, and the plan stays the same;
results do not depend on the number of slabs.

Defined results: a null or wordless text has no words and is clean; null or wordless items have no window;
repeated items, repeated documents and equal windows of several items all count (items once per id); an
item without an id marks words but is not listed; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import textbytes
from shelfwise.session import spread_out
from shelfwise.sources.tables import table

WINDOW = 10
BLOCK = 3
SLAB_WORDS = 500_000
LANE = 256
# Documents held while the slabs pass, when there are several.
HOLD_BYTES = 64 * 1024 * 1024
RESULT = "n_words bigint, spans array<struct<start:int,end:int>>, items array<string>, unnamed boolean"


class PatternClass:
    """Shift table and buckets of all patterns with `length` words."""

    def __init__(self, length: int, hashes: np.ndarray, texts: list[bytes], items: list[list[str | None]]):
        self.length, self.block = length, min(BLOCK, length)
        self.hashes, self.texts, self.items = hashes, texts, items  # hashes: (patterns, length)
        keys, shifts = [], []
        for end in range(self.block, length + 1):  # block of words end - block .. end - 1
            keys.append(block_hashes(hashes[:, end - self.block : end].reshape(-1), self.block)[:: self.block])
            shifts.append(np.full(len(hashes), length - end, np.int64))
        keys, shifts = np.concatenate(keys), np.concatenate(shifts)
        order = np.lexsort((shifts, keys))
        self.keys, at = np.unique(keys[order], return_index=True)
        self.shifts = shifts[order][at]
        # Buckets: patterns that end in the same block, each by the hash of all its words.
        whole = block_hashes(hashes.reshape(-1), length)[::length]
        self.buckets: dict[int, dict[int, int]] = {}
        for i, (suffix, code) in enumerate(zip(block_hashes(hashes[:, -self.block :].reshape(-1), self.block)[:: self.block].tolist(), whole.tolist())):
            self.buckets.setdefault(suffix, {})[code] = i

    def shift(self, blocks: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, blocks), len(self.keys) - 1)
        return np.where(self.keys[at] == blocks, self.shifts[at], self.length - self.block + 1)


def block_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Entry i: hash of the `size` words from i on; padded to the length of the input."""
    if size == 1:
        return textbytes.mix(hashes)
    found = textbytes.ngram_hashes(hashes, size)
    return np.concatenate([found, np.zeros(len(hashes) - len(found), np.uint64)])


def compile_patterns(items: Iterable[tuple[str | None, str]]) -> list[PatternClass]:
    """Pattern classes of (item id, text) rows; equal windows are one pattern with all their items."""
    rows = list(items)
    if not rows:
        return []
    word_table = textbytes.alphanumeric_table()
    by_length: dict[int, dict[bytes, tuple[np.ndarray, set]]] = {}
    for first, end, data, offsets in textbytes.blocks(pa.array([t for _, t in rows], pa.string())):
        found = textbytes.words(data, offsets, word_table)
        hashes = textbytes.word_hashes(found)
        for d in range(end - first):
            low, high = found.first[d], found.first[d + 1]
            n = min(WINDOW, high - low)
            for start in range(low, high - n + 1) if n else ():
                text = _joined(found, start, n)
                known = by_length.setdefault(int(n), {})
                known.setdefault(text, (hashes[start : start + n], set()))[1].add(rows[first + d][0])
    return [
        PatternClass(n, np.stack([h for h, _ in known.values()]), list(known), [list(i) for _, i in known.values()])
        for n, known in sorted(by_length.items())
    ]


def occurrences(found: textbytes.Words, hashes: np.ndarray, group: PatternClass) -> Iterator[tuple[int, int]]:
    """(first word, pattern) of every occurrence of the patterns of a class in a block of texts."""
    m, b = group.length, group.block
    counts = np.diff(found.first)
    lanes_of = np.where(counts >= m, (counts - m) // LANE + 1, 0)
    lane_doc = np.repeat(np.arange(len(counts)), lanes_of)
    if not len(lane_doc):
        return
    lane_no = np.arange(len(lane_doc)) - np.repeat(np.cumsum(lanes_of) - lanes_of, lanes_of)
    # A lane owns the window ends first + m - 1 .. first + m - 2 + LANE of its text.
    at = found.first[lane_doc] + lane_no * LANE + m - 1
    stop = np.minimum(at + LANE, found.first[lane_doc + 1])
    blocks = block_hashes(hashes, b)
    candidates = []
    while len(at):
        shift = group.shift(blocks[at - b + 1])
        candidates.append(at[shift == 0])
        at = at + np.maximum(shift, 1)
        active = at < stop
        at, stop = at[active], stop[active]
    starts = np.concatenate(candidates) - m + 1
    suffixes, whole = blocks[starts + m - b], block_hashes(hashes, m)[starts]
    for start, suffix, code in zip(starts.tolist(), suffixes.tolist(), whole.tolist()):
        pattern = group.buckets[suffix].get(code)
        if pattern is not None and _joined(found, start, m) == group.texts[pattern]:
            yield start, pattern


def _joined(found: textbytes.Words, start: int, n: int) -> bytes:
    return b" ".join(textbytes.word_text(found, i) for i in range(start, start + n))


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def scan(texts: pa.Array, groups: list[PatternClass]) -> list[tuple[int, list[tuple[int, int]], set]]:
    """Per text: number of words, merged word spans inside occurrences, ids of the items that occur."""
    out: list[tuple[int, list[tuple[int, int]], set]] = []
    word_table = textbytes.alphanumeric_table()
    for first, end, data, offsets in textbytes.blocks(texts):
        found = textbytes.words(data, offsets, word_table)
        hashes = textbytes.word_hashes(found)
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set] = {}
        for group in groups:
            for start, pattern in occurrences(found, hashes, group):
                d = int(np.searchsorted(found.first, start, "right")) - 1
                begin = start - int(found.first[d])
                spans.setdefault(d, []).append((begin, begin + group.length))
                items.setdefault(d, set()).update(group.items[pattern])
        counts = np.diff(found.first).tolist()
        out += [(counts[d], merge_spans(spans.get(d, [])), items.get(d, set())) for d in range(end - first)]
    return out


def pattern_slabs(items: DataFrame, id_col: str, text_col: str, slab_words: int) -> Iterator[list[tuple[str | None, str]]]:
    """The benchmark in parts of about `slab_words` words; one part at a time is on the driver."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).filter("text IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // (6 * slab_words)))
    for slab in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == slab)
        yield [(r.item, r.text) for r in part.collect()]


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    slab_words: int = SLAB_WORDS,
) -> DataFrame:
    """One row per document: its id, `n_words`, merged word `spans` that occur in the benchmark, `items` (sorted ids)."""
    slabs = share_slabs(pattern_slabs(items, item_id, item_text, slab_words), docs.sparkSession)
    rows = spread_out(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in slabs.scan_batches(batches, 1):
            spans = [[{"start": start, "end": end} for start, end in each] for _, each, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([n for n, _, _ in found], pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array([sorted(i for i in ids if i is not None) for _, _, ids in found], pa.list_(pa.string())),
                 pa.array([None in ids for _, _, ids in found], pa.bool_())],
                names=["id", "n_words", "spans", "items", "unnamed"],
            )

    found = rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, {RESULT}")
    return found.select(F.col("id").alias(id_col), "n_words", "spans", "items", "unnamed")


class Slabs:
    """Pattern slabs on every task; one is compiled at a time, and stays compiled if it is the only one."""

    def __init__(self, shared: list):
        self.shared, self.only = shared, None

    def groups(self, slab: int) -> list[PatternClass]:
        if self.only is not None:
            return self.only
        groups = compile_patterns(pickle.loads(zlib.decompress(self.shared[slab].value)))
        if len(self.shared) == 1:
            self.only = groups
        return groups

    def scan_batches(self, batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, list]]:
        """Batches with what `scan` finds of all slabs; batches are held together while several slabs pass."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if len(self.shared) == 1 or sum(b.nbytes for b in held) >= HOLD_BYTES:
                yield from self._scan_held(held, text_at)
                held = []
        yield from self._scan_held(held, text_at)

    def _scan_held(self, held: list[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, list]]:
        found: list[list] = [[] for _ in held]
        for slab in range(len(self.shared)) if held else ():
            groups = self.groups(slab)
            for at, batch in enumerate(held):
                new = scan(batch.column(text_at), groups)
                found[at] = [(n, merge_spans(a + b), i | j) for (n, a, i), (_, b, j) in zip(new, found[at])] if slab else new
        yield from zip(held, found)


def share_slabs(slabs: Iterator[list[tuple[str | None, str]]], spark: SparkSession) -> Slabs:
    """Broadcast slab after slab, as compressed text."""
    return Slabs([spark.sparkContext.broadcast(zlib.compress(pickle.dumps(slab))) for slab in slabs])


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", slab_words: int = SLAB_WORDS, **names: str) -> DataFrame:
    """The documents without any occurrence, all columns as they are."""
    found = pattern_slabs(items, names.get("item_id", "item_id"), names.get("item_text", "text"), slab_words)
    slabs, text_at = share_slabs(found, docs.sparkSession), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, results in slabs.scan_batches(batches, text_at):
            yield batch.filter(pa.array([not spans for _, spans, _ in results], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
QUERIES = {"op3_decontaminate": op3_decontaminate}
ORACLE = {
    "op3_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
starts AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS g FROM starts),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n),
hits AS (
  SELECT pos.rid, pos.p, pos.n, win.item_id
  FROM pos JOIN win ON pos.n = win.n AND array_to_string(list_slice(pos.w, pos.p, pos.p + pos.n - 1), ' ') = win.g),
words AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS k FROM hits) GROUP BY rid),
found AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN found USING (rid)
"""
}


def reference_scan(text: str | None, items: list[tuple[str, str | None]]) -> tuple[int, int, int, str, bool]:
    """Plain search of one text, for tests: n_words, n_hit, n_items, items_sha256, contaminated."""
    import re

    def split(value: str | None) -> list[str]:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    tokens, hit, ids = split(text), set(), set()
    for item, body in items:
        own = split(body)
        n = min(WINDOW, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(tokens) - n + 1) if n else ():
            if tuple(tokens[i : i + n]) in windows:
                hit.update(range(i, i + n))
                ids.add(str(item))
    return len(tokens), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)
