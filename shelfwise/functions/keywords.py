"""Arrow kernels of the keyword search: term counts and BM25 scores of token lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfwise.functions.topk import BestK, id_array

# Scores of a slice of documents held as a dense table; questions too many for one are scored as matching pairs.
DENSE_CELLS = 512 * 1024
# Fewer documents than this at a time are not worth a table.
DENSE_ROWS = 16
# Question terms scored together.
BLOCK_TERMS = 500_000
# Words, and matching (document, question, term) triples, held at once.
WORDS_AT_ONCE = 256 * 1024
MATCHES_AT_ONCE = 1024 * 1024


def term_codes(tokens: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code of every word in a batch of token lists, -1 for one nobody asks, and the list sizes."""
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    codes = pc.fill_null(pc.index_in(tokens.flatten(), value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    return codes, sizes


def slices(sizes: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most `rows` lists with about WORDS_AT_ONCE words together; one longer list is a range of its own."""
    ends, low = np.cumsum(sizes, dtype=np.int64), 0
    while low < len(sizes):
        before = ends[low - 1] if low else 0
        high = int(np.searchsorted(ends, before + WORDS_AT_ONCE, side="right"))
        yield low, (high := max(low + 1, min(high, low + rows)))
        low = high


def term_counts(tokens: pa.Array, vocabulary: pa.Array, rows: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row, row, term code, count, sizes) of every asked term, for slices of a batch of token lists."""
    codes, sizes = term_codes(tokens, vocabulary)
    starts = np.append(0, np.cumsum(sizes, dtype=np.int64))
    for low, high in slices(sizes, rows):
        part = codes[starts[low] : starts[high]]
        at = np.repeat(np.arange(high - low), sizes[low:high])
        wanted = part >= 0
        pairs, counts = np.unique(at[wanted] * len(vocabulary) + part[wanted], return_counts=True)
        yield low, high, pairs // len(vocabulary), pairs % len(vocabulary), counts, sizes[low:high]


@dataclass(frozen=True)
class QuestionBlock:
    """Questions scored together: the codes they ask, and who asks each; questions of one term lie next to each other."""

    question_ids: np.ndarray
    codes: np.ndarray
    starts: np.ndarray
    asking: np.ndarray


@dataclass(frozen=True)
class QuestionTerms:
    """The question side of a keyword search, bounded by the size check of its caller."""

    blocks: list[QuestionBlock]
    vocabulary: pa.Array
    idf: np.ndarray
    mean_size: float
    k1: float
    b: float

    @classmethod
    def build(
        cls, asked: pa.Table, vocabulary: pa.Array, frequency: np.ndarray, documents: int, mean_size: float, k1: float, b: float,
        block_terms: int = BLOCK_TERMS,
    ):
        """`asked` is (question_id, term); a block has at most `block_terms` of its rows, or one question."""
        question_ids, question = np.unique(id_array(asked["question_id"]), return_inverse=True)
        code = pc.index_in(asked["term"].combine_chunks(), value_set=vocabulary).to_numpy(zero_copy_only=False)
        ends, blocks, low = np.cumsum(np.bincount(question, minlength=len(question_ids))), [], 0
        by_question = np.argsort(question, kind="stable")
        while low < len(question_ids):
            before = int(ends[low - 1]) if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + block_terms, side="right")))
            rows = by_question[before : ends[high - 1]]
            rows = rows[np.argsort(code[rows], kind="stable")]
            codes, starts = np.unique(code[rows], return_index=True)
            blocks.append(QuestionBlock(question_ids[low:high], codes, np.append(starts, len(rows)), question[rows] - low))
            low = high
        idf = np.log1p((documents - frequency + 0.5) / (frequency + 0.5))
        return cls(blocks, vocabulary, idf, mean_size, k1, b)


class BlockK(BestK):
    """Best BM25 scores of one task for a block of questions."""

    def __init__(self, terms: QuestionTerms, block: QuestionBlock, k: int, best_per_id: bool = False):
        super().__init__(block.question_ids, k, best_per_id)
        self.terms, self.block = terms, block

    def take(self, ids: np.ndarray, row: np.ndarray, code: np.ndarray, count: np.ndarray, sizes: np.ndarray) -> None:
        """Score documents by the asked terms they hold, `row` by `row`."""
        t, asked = self.terms, self.block
        place = np.searchsorted(asked.codes, code)
        hit = asked.codes[np.minimum(place, len(asked.codes) - 1)] == code
        place, row, code, count = place[hit], row[hit], code[hit], count[hit]
        fan = asked.starts[place + 1] - asked.starts[place]
        total = int(fan.sum())
        if not total:
            return
        n, q = len(ids), len(self.question_ids)
        dense = q * DENSE_ROWS <= DENSE_CELLS
        if n > 1 and (total > MATCHES_AT_ONCE or (dense and n * q > DENSE_CELLS)):
            half, cut = n // 2, np.searchsorted(row, n // 2)
            self.take(ids[:half], row[:cut], code[:cut], count[:cut], sizes[:half])
            self.take(ids[half:], row[cut:] - half, code[cut:], count[cut:], sizes[half:])
            return
        norm = t.k1 * (1 - t.b + t.b * sizes[row] / t.mean_size)
        part = np.repeat(t.idf[code] * count * (t.k1 + 1) / (count + norm), fan)
        within = np.arange(total) - np.repeat(np.cumsum(fan) - fan, fan)
        question = asked.asking[np.repeat(asked.starts[place], fan) + within]
        row = np.repeat(row, fan)
        if dense:
            scores = np.bincount(row * q + question, weights=part, minlength=n * q).reshape(n, q)
            self.offer(ids, np.where(scores > 0, np.round(scores, 6), -np.inf), np.arange(q))
        else:
            cells, at = np.unique(row * q + question, return_inverse=True)
            self.offer_rows(cells % q, ids[cells // q], np.round(np.bincount(at, weights=part), 6))


class KeywordK:
    """Best BM25 scores of one task for all blocks of questions; its documents are read and counted once."""

    def __init__(self, terms: QuestionTerms, k: int, best_per_id: bool = False):
        self.terms, self.best = terms, [BlockK(terms, block, k, best_per_id) for block in terms.blocks]

    def add(self, batch: pa.RecordBatch) -> None:
        ids = id_array(batch["id"])
        for low, high, row, code, count, sizes in term_counts(batch["tokens"], self.terms.vocabulary, len(ids)):
            for best in self.best:
                best.take(ids[low:high], row, code, count, sizes)

    def batch(self, id_type: pa.DataType, question_type: pa.DataType) -> pa.RecordBatch:
        parts = [best.batch(id_type, question_type) for best in self.best]
        return pa.concat_batches(parts) if parts else BestK(np.array([], int), 1).batch(id_type, question_type)
