"""Vectorised tokenising of Arrow text columns: bytes, words and word hashes as numpy arrays.

UTF-8 makes this exact for ASCII-defined classes: every byte of a non-ASCII character is 0x80 or more.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes handled at a time; the arrays of one block take some 40 times as much. A longer document is a block alone.
BLOCK_BYTES = 1 << 20

_SEED = np.random.default_rng(0x5EED)
_BYTE_KEYS = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def alphanumeric_table() -> np.ndarray:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z; other bytes are 0."""
    table = _lowered()
    for low, high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        table[low : high + 1] = 0
    return table


def nonspace_table() -> np.ndarray:
    """Words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; white space is 0 (and NUL, a word byte, becomes 0xFF)."""
    table = _lowered()
    table[0] = 0xFF  # no byte of UTF-8
    for blank in (0x20, *range(0x09, 0x0E)):
        table[blank] = 0
    return table


class Words(NamedTuple):
    """Words of a block of texts: `starts`, `ends` in `data`, and `first[d]:first[d + 1]` are those of text d."""

    data: np.ndarray  # mapped bytes, 0 between words
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def blocks(texts: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of texts with about `limit` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    if not len(texts):
        return
    _, raw_offsets, raw = texts.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """Find the words of each text; a word never spans two texts."""
    mapped = table[data]
    inside = mapped != 0
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before[edges] = False
        edges = offsets[1:][offsets[1:] > 0]
        after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(mapped, starts, ends, np.searchsorted(starts, offsets))


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        table = np.full(size, base, np.uint64)
        table[0] = 1
        with np.errstate(over="ignore"):
            table = np.multiply.accumulate(table)
        if size > 4 * BLOCK_BYTES:  # one huge document: not worth keeping
            return table
        _POWERS[name] = have = table
    return have


def word_hashes(found: Words) -> np.ndarray:
    """A 64-bit hash of each word's mapped bytes, from one prefix sum over the block."""
    n = len(found.data)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_KEYS[found.data] * _powers("up", _BASE, n)[:n], out=sums[1:])
        spans = sums[found.ends] - sums[found.starts]
        spans *= _powers("down", _BASE_INVERSE, n + 1)[found.starts]
        return mix(spans + (found.ends - found.starts).astype(np.uint64))


def ngram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Order-dependent hash of each run of `size` words; entry i starts at word i."""
    total = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total += hashes[k : k + len(total)] * np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 2**64))
        return mix(total)


def word_text(found: Words, i: int) -> bytes:
    return found.data[found.starts[i] : found.ends[i]].tobytes()
