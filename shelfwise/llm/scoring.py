"""Language-model scores by prediction by partial matching (PPM), beside a word-frequency base score.

The model is a byte-context trie trained on the whole training part of the corpus. Its base has symbols after
two, one and no bytes of context. A symbol not seen in a context costs an escape (distinct over total
plus distinct, method C) to the next shorter context, where the symbols of the longer ones are excluded; the
last resort is uniform over what is left. Texts start after bytes 0xFF and end with one, which UTF-8
never holds. Each task counts its three-byte nodes, Spark adds the counts up; 2^24 nodes are possible, so
the base is at most that large whatever the corpus, and the table of code lengths built from it is 67 MB
at most.

Contexts of three to `order` bytes are a table that grows with the corpus and is on no driver. A symbol's chance
after k bytes is (n + d * its chance after k - 1 bytes) / (total + d), with d the distinct symbols seen there:
method C with the escape blended in, so no exclusion is needed and the chances of a context sum to one. A block
sends each of its distinct nodes once, with its training count, to the bucket of the last three context bytes.
All contexts of three bytes and more that end alike meet there, so a bucket adds up the counts, works out every
order and sends one code length per node back to the block. The number of buckets follows the corpus.

The base score needs the corpus count of every word. Texts are taken in blocks of 8 MB; a block sends each of
its distinct words once, counts are summed by word (a word has one row per block at most, however common) and
return to their block, where the documents are summed up. No vocabulary is broadcast or collected.

Defined results: a null or empty text has the end token only; equal rows and equal ids are scored one by one; an
empty table gives no rows; without any training row every count is 0 and the trie is uniform; a null id counts
as an empty one when rows are held out; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm import textbytes
from shelfwise.llm.folds import fold
from shelfwise.session import materialize, spread_out
from shelfwise.sources.tables import table

# Text bytes that share one word list.
DICTIONARY_BYTES = 8 << 20
# Bytes of context of the query's model, at most 6 (codes are 64-bit), and text bytes for each bucket of its nodes.
ORDER = 5
BUCKET_BYTES = 16 << 20
BASE_ORDER = 2
EDGE = 0xFF


def trigram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (two bytes of context, symbol) for every symbol of every text, its end included; texts start at `first`."""
    lengths = np.diff(offsets)
    first = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths + 1, out=first[1:])
    padded = np.full(len(data) + 3 * len(lengths), EDGE, np.uint8)
    keep = np.ones(len(padded), bool)
    for d, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        begin = low + 3 * d
        padded[begin + 2 : begin + 2 + high - low] = data[low:high]
        keep[begin : begin + 2] = False
    codes = padded.astype(np.int32)
    codes[1:] |= padded[:-1].astype(np.int32) << 8
    codes[2:] |= padded[:-2].astype(np.int32) << 16
    return codes[keep], first


def gram_codes(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (`order` bytes of context, symbol) as `trigram_codes` has them for two."""
    lengths = np.diff(offsets)
    first = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths + 1, out=first[1:])
    begins = offsets[:-1] + (order + 1) * np.arange(len(lengths))
    padded = np.full(len(data) + (order + 1) * len(lengths), EDGE, np.uint8)
    padded[np.arange(len(data)) + np.repeat(begins + order - offsets[:-1], lengths)] = data
    keep = np.ones(len(padded), bool)
    keep[(begins[:, None] + np.arange(order)).ravel()] = False
    codes = padded.astype(np.int64)
    for back in range(1, order + 1):
        codes[back:] |= padded[:-back].astype(np.int64) << 8 * back
    return codes[keep], first


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    at = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[at], np.add.reduceat(counts, at) if len(at) else counts


def count_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, n) of the trie's deepest nodes, summed over the task."""
    codes, counts = np.empty(0, np.int32), np.empty(0, np.int64)
    for batch in batches:
        for _, _, data, offsets in textbytes.blocks(batch["text"]):
            found = np.sort(trigram_codes(data, offsets)[0])
            at = np.flatnonzero(np.diff(found, prepend=-1))
            n = np.diff(np.append(at, len(found)))
            codes, counts = _summed(np.concatenate([codes, found[at]]), np.concatenate([counts, n]))
    yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int32()), pa.array(counts, pa.int64())], names=["code", "n"])


def train_trie(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the trie over a column `text`: at most 2^24 nodes."""
    nodes = texts.mapInArrow(count_nodes, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    return nodes["code"].to_numpy(), nodes["n"].to_numpy()


class CodeLengths(NamedTuple):
    """log10 probabilities: row `rows[context]` of `table` has those of the 256 symbols after the two bytes of a context.

    Contexts that were never seen share the row of their second byte, so the table has a row per seen context and
    256 more: at most 65,792 rows or 67 MB.
    """

    rows: np.ndarray
    table: np.ndarray

    def of(self, codes: np.ndarray) -> np.ndarray:
        return self.table[self.rows[codes >> 8], codes & 255]


def code_lengths(codes: np.ndarray, counts: np.ndarray) -> CodeLengths:
    """Code lengths of a trie."""
    seen, context = np.unique(codes >> 8, return_inverse=True)
    rows = np.arange(1 << 16, dtype=np.int32) % 256 + len(seen)
    rows[seen] = np.arange(len(seen))
    second = np.concatenate([seen & 255, np.arange(256)])
    one = np.zeros((256, 256), np.int64)
    np.add.at(one, (codes >> 8 & 255, codes & 255), counts)
    none = one.sum(axis=0)
    table_ = np.empty((len(second), 256), np.float32)
    for low in range(0, len(second), 1024):
        own = slice(low, low + 1024)
        two = np.zeros((len(second[own]), 256), np.int64)
        at = (context >= low) & (context < low + 1024)
        two[context[at] - low, codes[at] & 255] = counts[at]
        chance, excluded = np.zeros(two.shape), np.zeros(two.shape, bool)
        reach = np.ones((len(two), 1))  # probability of having escaped so far
        for level in (two, one[second[own]], none[None, :]):
            left = np.where(excluded, 0, level)
            kinds, total = (left > 0).sum(axis=1, keepdims=True), left.sum(axis=1, keepdims=True)
            size = np.maximum(total + kinds, 1)
            chance += reach * left / size
            reach = np.where(kinds > 0, reach * kinds / size, reach)
            excluded = excluded | (left > 0)
        rest = (~excluded).sum(axis=1, keepdims=True)
        chance += np.where(excluded, 0.0, reach / np.maximum(rest, 1))
        table_[own] = np.log10(chance)
    return CodeLengths(rows, table_)


def deep_chances(codes: np.ndarray, counts: np.ndarray, base: CodeLengths, order: int) -> np.ndarray:
    """log10 probability of every node of `order` bytes of context; all nodes with the same last three are given."""
    chance = 10.0 ** base.of(codes & 0xFFFFFF).astype(np.float64)
    for depth in range(BASE_ORDER + 1, order + 1):
        nodes, node = np.unique(codes & ((1 << 8 * (depth + 1)) - 1), return_inverse=True)
        n = np.bincount(node, counts, len(nodes))
        contexts, context = np.unique(nodes >> 8, return_inverse=True)
        kinds = np.bincount(context, n > 0, len(contexts))
        size = np.bincount(context, n, len(contexts)) + kinds
        own = context[node]
        chance = np.where(size[own] > 0, (n[node] + kinds[own] * chance) / np.maximum(size[own], 1), chance)
    return np.log10(chance).astype(np.float32)


def ppm_scores(texts: pa.Array, lengths: CodeLengths) -> np.ndarray:
    """log10 probability of each text under the trie."""
    out = [np.empty(0)]
    for _, _, data, offsets in textbytes.blocks(texts):
        out.append(_block_scores(data, offsets, lengths))
    return np.concatenate(out)


def _block_scores(data: np.ndarray, offsets: np.ndarray, lengths: CodeLengths) -> np.ndarray:
    codes, first = trigram_codes(data, offsets)
    return np.add.reduceat(lengths.of(codes), first[:-1], dtype=np.float64)


def score_texts(docs: DataFrame, lengths: CodeLengths, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) with code lengths from `code_lengths`, which are 67 MB at most for any corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(ppm_scores(batch.column(1), shared.value), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=[id_col, "score"])

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _binary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as one binary column."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    take = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data[take])])


def _one(values, kind: pa.DataType) -> pa.Array:
    """A column of one row that holds a list."""
    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as bytes of seven bits, the highest bit set on all but a number's last byte."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 7))
    sizes = np.ones(len(values), np.int64)
    for k in range(1, width):
        sizes += values >= 1 << 7 * k
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(width):
        own = np.flatnonzero(sizes > k)
        out[ends[own] - sizes[own] + k] = (values[own] >> 7 * k & 127) | np.where(sizes[own] > k + 1, 128, 0)
    return out.tobytes()


def unpack(data: bytes) -> np.ndarray:
    """The numbers `pack` was given."""
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    first = np.concatenate([[0], last[:-1] + 1]).astype(np.int64) if len(last) else last
    place = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << 7 * place, first) if len(first) else np.empty(0, np.int64)


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def stretch(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def code_values(values: np.ndarray) -> bytes:
    """Numbers of which few differ, as places in a table of them."""
    distinct, place = np.unique(values, return_inverse=True)
    kind = np.min_scalar_type(max(len(distinct) - 1, 0))
    return squeeze(b"".join((np.uint32(len(distinct)).tobytes(), distinct.astype(np.float32).tobytes(), place.astype(kind).tobytes())))


def coded_values(data: bytes) -> np.ndarray:
    raw = stretch(data)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    places = np.frombuffer(raw, np.min_scalar_type(max(n - 1, 0)), offset=4 + 4 * n)
    return np.frombuffer(raw, np.float32, n, 4)[places]


def _buckets_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each node, by the last three bytes of its context."""
    return (textbytes.mix((codes >> 8 & 0xFFFFFF).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


class _Nodes:
    """Distinct nodes of a block with their training counts, and the block's texts."""

    def __init__(self, order: int, buckets: int):
        self.order, self.buckets = order, buckets
        self.codes, self.counts, self.texts, self.lengths = [], [], [], []

    def add(self, data: np.ndarray, offsets: np.ndarray, held: np.ndarray) -> None:
        lengths = np.diff(offsets)
        found = np.sort(gram_codes(data, offsets, self.order)[0] << 1 | np.repeat(held, lengths + 1))
        at = np.flatnonzero(np.diff(found >> 1, prepend=-1))
        self.codes.append(found[at] >> 1)
        self.counts.append(np.add.reduceat(1 - (found & 1), at))
        self.texts.append(data.tobytes())
        self.lengths.append(lengths)

    def columns(self) -> dict[str, pa.Array]:
        codes, counts = _summed(np.concatenate(self.codes), np.concatenate(self.counts))
        bucket = _buckets_of(codes, self.buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, codes, counts = bucket[order], codes[order], counts[order]
        at = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
        nodes = [
            {"bucket": int(bucket[low]), "codes": squeeze(pack(np.diff(codes[low:high], prepend=0))), "n": squeeze(pack(counts[low:high]))}
            for low, high in zip(at[:-1], at[1:])
        ]
        kind = pa.list_(pa.struct([("bucket", pa.int32()), ("codes", pa.binary()), ("n", pa.binary())]))
        return {
            "texts": pa.array([squeeze(b"".join(self.texts))], pa.binary()),
            "lengths": pa.array([pack(np.concatenate(self.lengths))], pa.binary()),
            "nodes": pa.array([nodes], kind),
        }


def _learner(shared, order: int):
    """Code lengths of the nodes of a bucket, handed back to each block in the order it sent them; rows come by bucket."""

    def answers(rows: list[tuple[int, bytes, bytes]], bucket: int) -> Iterator[pa.RecordBatch]:
        codes, counts, waiting = np.empty(0, np.int64), np.empty(0, np.int64), []
        for _, sent, n in rows:
            waiting.append((np.cumsum(unpack(stretch(sent))), unpack(stretch(n))))
            if sum(len(c) for c, _ in waiting) > max(1 << 20, len(codes)):
                codes, counts = _summed(*(np.concatenate(part) for part in zip((codes, counts), *waiting)))
                waiting = []
        codes, counts = _summed(*(np.concatenate(part) for part in zip((codes, counts), *waiting)))
        chance = deep_chances(codes, counts, shared.value, order)
        for low in range(0, len(rows), 64):
            own = rows[low : low + 64]
            found = [code_values(chance[np.searchsorted(codes, np.cumsum(unpack(stretch(sent))))]) for _, sent, _ in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block for block, _, _ in own], pa.int64()), pa.array([bucket] * len(own), pa.int32()), pa.array(found, pa.binary())],
                names=["block", "bucket", "chances"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, bucket = [], None
        for batch in batches:
            for block, own, codes, n in zip(*(batch[c].to_pylist() for c in ("block", "bucket", "codes", "n"))):
                if own != bucket and rows:
                    yield from answers(rows, bucket)
                    rows = []
                bucket = own
                rows.append((block, codes, n))
        if rows:
            yield from answers(rows, bucket)

    return run


def _text_blocks(texts: bytes, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """`textbytes.blocks` of a block's texts."""
    offsets = np.append(0, np.cumsum(lengths))
    return textbytes.blocks(pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(texts)))


def _deep_scores(texts: bytes, lengths: np.ndarray, answers: list[dict], order: int, buckets: int) -> np.ndarray:
    """log10 probability of each text of a block, from the code lengths of its nodes in the order `_Nodes` sent them."""
    parts = []
    for _, _, data, own in _text_blocks(texts, lengths):
        grams, first = gram_codes(data, own, order)
        distinct, place = np.unique(grams, return_inverse=True)
        parts.append((distinct, place.astype(np.int32), first))
    codes = np.unique(np.concatenate([distinct for distinct, _, _ in parts]))
    chances = np.empty(len(codes), np.float32)
    by_bucket = np.argsort(_buckets_of(codes, buckets), kind="stable")
    chances[by_bucket] = np.concatenate([coded_values(a["chances"]) for a in sorted(answers, key=lambda a: a["bucket"])])
    out = [
        np.add.reduceat(chances[np.searchsorted(codes, distinct)][place], first[:-1], dtype=np.float64)
        for distinct, place, first in parts
    ]
    return np.concatenate(out)


class _Block:
    """Documents of up to DICTIONARY_BYTES of text: their words as numbers into the block's own word list, and that list."""

    def __init__(self, nodes: _Nodes | None = None):
        self.nodes = nodes
        self.ids, self.held, self.scores, self.owners, self.words, self.hashes, self.entries = [], [], [], [], [], [], []
        self.bytes = self.docs = self.known = 0

    def add(self, ids: pa.Array, held: np.ndarray, scores: np.ndarray, found: textbytes.Words) -> None:
        distinct, at, word = np.unique(textbytes.word_hashes(found), return_index=True, return_inverse=True)
        self.ids.append(ids)
        self.held.append(held)
        self.scores.append(scores)
        self.owners.append(np.repeat(np.arange(self.docs, self.docs + len(ids), dtype=np.int32), np.diff(found.first)))
        self.words.append(_binary(found.data, found.starts[at], found.ends[at]))
        self.hashes.append(distinct)
        self.entries.append((word + self.known).astype(np.int32))
        self.docs += len(ids)
        self.known += len(distinct)
        self.bytes += len(found.data)

    def bag(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of the distinct words; owner, entry and times of every document's words."""
        _, at, merged = np.unique(np.concatenate(self.hashes), return_index=True, return_inverse=True)
        n = max(len(at), 1)
        pairs = np.concatenate(self.owners).astype(np.int64) * n
        pairs += merged[np.concatenate(self.entries)]
        pairs, times = np.unique(pairs, return_counts=True)
        return at, *np.divmod(pairs, n), times

    def row(self) -> pa.RecordBatch:
        at, owner, entry, times = self.bag()
        held = np.concatenate(self.held)
        columns = {
            "ids": _one(pa.concat_arrays(self.ids), None),
            "held": _one(held, pa.bool_()),
            "scores": _one(np.concatenate(self.scores), pa.float64()),
            "words": _one(pa.concat_arrays(self.words).take(pa.array(at)), pa.binary()),
            "learned": _one(np.bincount(entry, np.where(held[owner], 0, times), len(at)).astype(np.int64), pa.int64()),
        }
        if self.nodes:  # the texts are sent on, and the bag is made again from them
            columns |= self.nodes.columns()
        else:
            sizes = np.bincount(owner, minlength=self.docs)
            gaps = np.diff(entry, prepend=0)
            begins = np.flatnonzero(np.diff(owner, prepend=-1))
            gaps[begins] = entry[begins]
            columns |= {name: pa.array([pack(values)], pa.binary()) for name, values in (("bag", sizes), ("gaps", gaps), ("times", times))}
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _block_maker(shared, order: int, buckets: int):
    """One row per block of documents, with the documents' PPM scores; of a deeper model, with its nodes instead."""
    mapped = textbytes.nonspace_table()

    def new() -> _Block:
        return _Block(_Nodes(order, buckets) if order > BASE_ORDER else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = new()
        for batch in batches:
            held = np.asarray(batch["held_out"].to_numpy(zero_copy_only=False), bool)
            for low, high, data, offsets in textbytes.blocks(batch["text"]):
                if block.nodes:
                    block.nodes.add(data, offsets, held[low:high])
                scores = np.zeros(high - low) if block.nodes else _block_scores(data, offsets, shared.value)
                block.add(batch["id"].slice(low, high - low), held[low:high], scores, textbytes.words(data, offsets, mapped))
                if block.bytes >= DICTIONARY_BYTES:
                    yield block.row()
                    block = new()
        if block.docs:
            yield block.row()

    return run


def _sent_bag(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, entry and times of every word of a block."""
    sizes, times = unpack(batch["bag"][row].as_py()), unpack(batch["times"][row].as_py())
    entries = np.cumsum(unpack(batch["gaps"][row].as_py()))
    doc = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes  # gaps start anew in every document
    filled = sizes > 0
    base = np.zeros(len(sizes), np.int64)
    base[filled] = np.where(before[filled] > 0, entries[before[filled] - 1], 0)
    return doc, entries - base[doc], times


def _text_bag(texts: bytes, lengths: np.ndarray, mapped: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same from the block's texts: words are numbered as when the block was made."""
    block = _Block()
    for low, high, data, offsets in _text_blocks(texts, lengths):
        block.add(pa.nulls(high - low), np.zeros(0, bool), np.zeros(0), textbytes.words(data, offsets, mapped))
    return block.bag()[1:]


def _scorer(n: int, distinct: int, end_count: int, order: int, buckets: int):
    """Rows of documents from blocks whose word counts, and code lengths of a deeper model, have come back."""
    below = n + 0.5 * (distinct + 1)
    end = math.log10((end_count + 0.5) / below)
    mapped = textbytes.nonspace_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                model = batch["scores"][row].values
                if order > BASE_ORDER:
                    texts, lengths = stretch(batch["texts"][row].as_py()), unpack(batch["lengths"][row].as_py())
                    model = pa.array(_deep_scores(texts, lengths, batch["answers"][row].as_py(), order, buckets), pa.float64())
                    doc, entries, times = _text_bag(texts, lengths, mapped)
                else:
                    doc, entries, times = _sent_bag(batch, row)
                size = len(model)
                counts = np.zeros(int(batch["n_words"][row].as_py()), np.int64)
                counts[batch["places"][row].values.to_numpy()] = batch["counts"][row].values.to_numpy()
                each = counts[entries]
                score = np.bincount(doc, times * np.log10((each + 0.5) / below), size) + end
                known = np.bincount(doc, np.where(each > 0, times, 0), size).astype(np.int64) + int(end_count > 0)
                tokens = np.bincount(doc, times, size).astype(np.int64) + 1
                yield pa.RecordBatch.from_arrays(
                    [batch["ids"][row].values, batch["held"][row].values, pa.array(tokens), pa.array(known),
                     pa.array(np.full(size, n, np.int64)), pa.array(score, pa.float64()), model],
                    names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                    order: int = BASE_ORDER) -> DataFrame:
    """PPM score and word base score of every document, learning from the rows where `held_out` is false.

    `order` is the bytes of context: two for the base alone, which is bounded, three to six for a model that grows."""
    if not BASE_ORDER <= order <= 6:
        raise ValueError(f"order {order} is not between {BASE_ORDER} and 6")
    spark = docs.sparkSession
    narrow = spread_out(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out.alias("held_out")))
    lengths = code_lengths(*train_trie(narrow.filter(~F.col("held_out")).select("text")))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"ids array<{id_type}>, held array<boolean>, scores array<double>, words array<binary>, learned array<bigint>"
    )
    shared, buckets = spark.sparkContext.broadcast(lengths), 1
    if order > BASE_ORDER:
        schema += ", texts binary, lengths binary, nodes array<struct<bucket:int,codes:binary,n:binary>>"
        total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(2 * spark.sparkContext.defaultParallelism, -(-total // BUCKET_BYTES))
    else:
        schema += ", bag binary, gaps binary, times binary"
    blocks = narrow.mapInArrow(_block_maker(shared, order, buckets), schema)
    blocks = materialize(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    listed = blocks.select("block", F.posexplode(F.arrays_zip("words", "learned")).alias("place", "entry"))
    # A word has one row per block at most, so one shuffle by word both adds up and hands back.
    word = Window.partitionBy(F.col("entry.words"))
    counted = listed.select(
        "block", "place", F.sum("entry.learned").over(word).alias("n"), (F.min("block").over(word) == F.col("block")).alias("first")
    ).filter("n > 0")
    returned = counted.groupBy("block").agg(
        F.collect_list(F.struct("place", "n")).alias("known"),
        F.count(F.when(F.col("first"), 1)).alias("v"),
    )
    returned = materialize(returned.select("block", "v", "known.place", "known.n"), "counts")
    v = returned.agg(F.sum("v")).first()[0] or 0
    learned = blocks.agg(
        F.sum(F.aggregate("learned", F.lit(0).cast("bigint"), lambda a, b: a + b)), F.sum(F.size(F.filter("held", lambda h: ~h)))
    ).first()
    ends = learned[1] or 0
    n = (learned[0] or 0) + ends
    joined = blocks.drop("learned").withColumn("n_words", F.size("words").cast("bigint")).drop("words").join(returned, "block", "left")
    carried = ["bag", "gaps", "times"]
    if order > BASE_ORDER:
        sent = blocks.select("block", F.explode("nodes").alias("node")).select("block", "node.*")
        sent = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")
        handed = sent.mapInArrow(_learner(shared, order), "block bigint, bucket int, chances binary")
        joined = joined.join(handed.groupBy("block").agg(F.collect_list(F.struct("bucket", "chances")).alias("answers")), "block")
        carried = ["texts", "lengths", "answers"]
    joined = joined.select(
        "ids", "held", "scores", "n_words", *carried,
        F.coalesce("place", F.array().cast("array<int>")).alias("places"),
        F.coalesce("n", F.array().cast("array<bigint>")).alias("counts"),
    )
    out = (
        f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
    return joined.mapInArrow(_scorer(n, v + (ends > 0), ends, order, buckets), out).withColumnRenamed("id", id_col)


def op7_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), fold("doc_id") == 1, order=ORDER)


QUERIES = {"op7_score": op7_score}
ORACLE: dict[str, str] = {}
