"""Top-k of a slice of questions against one part of a corpus: tiles of single-precision scores, few rows kept of each.

A tile is one matrix product; only scores that reach a question's threshold leave it. A search by codes keeps the `depth`
best rows by code of every question and scores those by their vectors. An exact search keeps what reaches the k-th
score less the error of single precision, and scores that in double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfwise.functions.topk import SCORES_AT_ONCE

# Candidates that wait to be merged with the rows held.
WAITING = 2 * 1024 * 1024
# Rows of a tile that all questions meet, and rows the first thresholds are taken from.
TILE_ROWS = 4096
SAMPLE_ROWS = 4096
# Candidates scored one by one at a time.
PAIRS_AT_ONCE = 65_536
# Scopes a question is looked up in by one bit each; more of them share bits and are looked up again.
SCOPE_BITS = 1 << 20
DECIMALS = 6


@dataclass(frozen=True)
class Part:
    """Rows of a corpus, in order of scope and id when each has one scope, else of id."""

    ids: pa.Array
    place: np.ndarray  # of the row's id among the ids of the part; copies share one
    distinct: pa.Array
    raw: np.ndarray
    scopes: np.ndarray | None
    codes: np.ndarray | None

    @classmethod
    def of(cls, rows: pa.Table) -> Part:
        rows = rows.take(pc.sort_indices(_whole(rows["id"])))
        n, scopes = rows.num_rows, None
        if "scopes" in rows.column_names:
            scopes = _flat(rows["scopes"]).reshape(n, -1)
            if scopes.shape[1] == 1:
                order = np.argsort(scopes[:, 0], kind="stable")
                rows, scopes = rows.take(pa.array(order)), scopes[order]
        ids = _whole(rows["id"])
        distinct = pc.unique(ids)
        distinct = distinct.take(pc.sort_indices(distinct))
        codes = None
        if "code" in rows.column_names:
            codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(n, -1)
        place = pc.index_in(ids, value_set=distinct).to_numpy(zero_copy_only=False)
        return cls(ids, place.astype(np.int64), distinct, _flat(rows["vector"]).reshape(n, -1), scopes, codes)

    # What follows is made where the part is searched, once per worker.

    @cached_property
    def norms(self) -> np.ndarray:
        slices = (self.raw[at : at + TILE_ROWS].astype(np.float64) for at in range(0, len(self.raw), TILE_ROWS))
        return np.concatenate([np.sqrt(np.square(rows).sum(axis=1)) for rows in slices])

    def rows(self, at: np.ndarray) -> np.ndarray:
        return self.raw[at].astype(np.float64) / self.norms[at][:, None]

    @cached_property
    def unit(self) -> np.ndarray:
        return np.divide(self.raw, self.norms[:, None], dtype=np.float32, casting="same_kind")


def _whole(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _flat(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return _whole(column).flatten().to_numpy(zero_copy_only=False)


class PartSearch:
    """Searches of one part: `decode` turns scopes and codes into what coarse scores are products with."""

    def __init__(self, part: Part, k: int, depth: int | None, skip_same: bool, decode: Callable | None = None):
        self.part, self.k, self.depth, self.skip_same, self.decode = part, k, depth, skip_same, decode
        # Rounding of a product in single precision, and of two scores to their decimals.
        self.margin = np.float32((part.raw.shape[1] + 8) * 2.0**-23 + 10.0**-DECIMALS)
        self.single = part.scopes is not None and part.scopes.shape[1] == 1
        if self.single:
            self.names, self.starts = np.unique(part.scopes[:, 0], return_index=True)
            self.stops = np.append(self.starts[1:], len(part.raw))

    def coarse(self, at: np.ndarray | slice) -> np.ndarray:
        if self.decode is None:
            return self.part.unit[at]
        return self.decode(self.part.scopes[at], self.part.codes[at]).astype(np.float32, copy=False)

    def search(self, ids: pa.Array, vectors: np.ndarray, coarse: np.ndarray, scopes: pa.Array | None) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """(question, id, score, rows scored) of the best k rows of each question; the last is given once per question.

        `vectors` are unit rows, `coarse` what the coarse scores of the questions are products with.
        """
        n = len(vectors)
        same = np.full(n, -1, np.int64)
        if self.skip_same:
            same = pc.fill_null(pc.index_in(_whole(ids), value_set=self.part.distinct), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        slice_ = _Slice(self, vectors, coarse.astype(np.float32, copy=False), scopes, same)
        first = slice_.first_thresholds()
        question, row, score = slice_.run(np.arange(n), first)
        if self.depth is not None:
            # A threshold from the sample may have been too high for some.
            short = np.flatnonzero((np.bincount(question, minlength=n) < self.depth) & (first > -np.inf))
            if len(short):
                more = slice_.run(short, np.full(n, -np.inf, np.float32))
                kept = ~np.isin(question, short)
                question, row, score = (np.concatenate([a[kept], b]) for a, b in zip((question, row, score), more))
            listed = np.bincount(question, minlength=n)
            question, row, score = slice_.exact_best(question, row)
        else:
            listed = np.bincount(question, minlength=n)
        new = np.append(True, question[1:] != question[:-1])[: len(question)]
        return question, self.part.ids.take(pa.array(row)), score, np.where(new, listed[question], 0)


class _Slice:
    def __init__(self, held: PartSearch, vectors: np.ndarray, coarse: np.ndarray, scopes: pa.Array | None, same: np.ndarray):
        self.held, self.vectors, self.coarse, self.same = held, vectors, coarse, same
        self.place, self.single = held.part.place, vectors.astype(np.float32)
        self.meets = self.bits = None
        if scopes is not None and held.part.scopes is not None:
            lists = _whole(scopes)
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            self.width = int(min(SCOPE_BITS, max(held.part.scopes.max(initial=0), values.max(initial=0)) + 1))
            if held.single:
                at = np.searchsorted(held.names, values)
                known = at < len(held.names)
                known[known] = held.names[at[known]] == values[known]
                self.meets = np.zeros((len(held.names), len(vectors)), bool)
                self.meets[at[known], owner[known]] = True
            else:
                self.bits = self._bits(owner, values, len(vectors))
                # All scopes in order, for those that share a bit.
                self.listed = np.unique(owner * (1 << 40) + values) if self.width == SCOPE_BITS else None

    def _bits(self, owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        out = np.empty((n, (self.width + 7) // 8), np.uint8)
        ends = np.searchsorted(owner, np.arange(n + 1))
        for low in range(0, n, 32):
            high = min(n, low + 32)
            flags = np.zeros((high - low, self.width), bool)
            part = slice(ends[low], ends[high])
            flags[owner[part] - low, values[part] % self.width] = True
            out[low:high] = np.packbits(flags, axis=1, bitorder="little")
        return out

    def _meet(self, question: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Which pairs share a scope."""
        if self.bits is None:
            return np.ones(len(question), bool)
        out = np.zeros(len(question), bool)
        for column in self.held.part.scopes.T:
            value = column[row] % self.width
            out |= (self.bits[question, value >> 3] >> (value & 7).astype(np.uint8) & 1).astype(bool)
        if self.listed is not None:
            maybe = np.flatnonzero(out)
            for low in range(0, len(maybe), PAIRS_AT_ONCE):
                part = maybe[low : low + PAIRS_AT_ONCE]
                keys = question[part, None] * (1 << 40) + self.held.part.scopes[row[part]]
                at = np.minimum(np.searchsorted(self.listed, keys), len(self.listed) - 1)
                out[part] = (self.listed[at] == keys).any(axis=1)
        return out

    def first_thresholds(self) -> np.ndarray:
        """Scores that about twice as many rows reach as are wanted, from a sample of the part; -inf if it cannot tell."""
        n, total = len(self.vectors), len(self.place)
        out = np.full(n, -np.inf, np.float32)
        wanted = self.held.depth or self.held.k
        if total < 4 * SAMPLE_ROWS or not n:
            return out
        rows = np.sort(np.random.default_rng(42).choice(total, SAMPLE_ROWS, replace=False))
        if self.held.depth is None:
            rank = wanted  # a bound: as many rows of the sample reach it, one of which may be the question's own
        else:
            share = wanted * SAMPLE_ROWS / total
            rank = int(np.ceil(share + 3 * np.sqrt(share) + 3))
        looked = min(SAMPLE_ROWS, 8 * (rank + 1))
        if rank * 4 > SAMPLE_ROWS:
            return out
        sample = self.held.coarse(rows)
        segment = np.searchsorted(self.held.starts, rows, side="right") - 1 if self.meets is not None else None
        step = max(1, SCORES_AT_ONCE // SAMPLE_ROWS)
        for low in range(0, n, step):
            scores = self.coarse[low : low + step] @ sample.T
            if segment is not None:
                scores[~self.meets[segment, low : low + step].T] = -np.inf
            top = np.argpartition(scores, -looked, axis=1)[:, -looked:]
            best = np.take_along_axis(scores, top, 1)
            asked = np.broadcast_to(np.arange(low, low + len(scores))[:, None], top.shape)
            row = rows[top]
            ok = self._meet(asked.ravel(), row.ravel()).reshape(top.shape) & (self.place[row] != self.same[asked])
            best[~ok] = -np.inf
            out[low : low + step] = -np.partition(-best, rank - 1, axis=1)[:, rank - 1]
        return out - self.held.margin

    def _tiles(self, asked: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first row, end, questions) of the tiles in which pairs may meet."""
        total = len(self.place)
        if self.meets is None or self.meets.all():
            for low in range(0, total, TILE_ROWS):
                yield low, min(total, low + TILE_ROWS), asked
            return
        for name, (low, high) in enumerate(zip(self.held.starts.tolist(), self.held.stops.tolist())):
            met = asked[self.meets[name, asked]]
            if len(met):
                for begin in range(low, high, TILE_ROWS):
                    yield begin, min(high, begin + TILE_ROWS), met

    def run(self, asked: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(question, row, score) kept of all tiles, ordered by question, best first."""
        kept = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32 if self.held.depth else np.float64)
        least, waiting, n = thresholds.copy(), [], 0
        room = np.empty(SCORES_AT_ONCE, np.float32)
        for low, high, met in self._tiles(asked):
            rows = self.held.coarse(slice(low, high))
            step = max(1, SCORES_AT_ONCE // len(rows))
            for begin in range(0, len(met), step):
                part = met[begin : begin + step]
                own = self.coarse if len(part) == len(self.coarse) else self.coarse[part]
                scores = np.matmul(own, rows.T, out=room[: len(part) * len(rows)].reshape(len(part), len(rows)))
                hit = np.flatnonzero(scores >= least[part, None])
                if not len(hit):
                    continue
                question, row = np.divmod(hit, len(rows))
                question, row, score = part[question], row + low, scores.ravel()[hit]
                ok = self.place[row] != self.same[question]
                if self.bits is not None:
                    ok &= self._meet(question, row)
                if not ok.all():
                    question, row, score = question[ok], row[ok], score[ok]
                waiting.append((question, row, score))
                n += len(question)
                if n >= WAITING:
                    kept, least = self._merged(kept, waiting, least)
                    waiting, n = [], 0
        return self._merged(kept, waiting, least)[0]

    def _merged(self, kept, waiting: list, least: np.ndarray):
        if not waiting:
            return kept, least
        question, row, score = (np.concatenate(column) for column in zip(*waiting))
        wanted = self.held.depth or self.held.k
        if self.held.depth is None:
            score = self._exact(question, row)
        question, row, score = (np.concatenate(pair) for pair in zip(kept, (question, row, score)))
        order = self._order(question, row, score)
        question = question[order]
        place = np.arange(len(order)) - np.searchsorted(question, question, side="left")
        order, question = order[place < wanted], question[place < wanted]
        row, score = row[order], score[order]
        last = np.flatnonzero(place[place < wanted] == wanted - 1)
        if self.held.depth is None:
            floor = score[last].astype(np.float32) - self.held.margin
        else:  # where rows come in order of their ids an equal score comes too late
            floor = score[last] if self.held.single else np.nextafter(score[last], np.float32(np.inf))
        least = least.copy()
        least[question[last]] = np.maximum(least[question[last]], floor)
        return (question, row, score), least

    def _order(self, question: np.ndarray, row: np.ndarray, score: np.ndarray) -> np.ndarray:
        if self.held.depth is None:
            return np.lexsort((self.place[row], -score, question))
        bits = (-score + np.float32(0)).view(np.int32).astype(np.int64)
        bits = np.where(bits < 0, np.int64(-(2**31)) - bits, bits)
        key = (question << 33) + bits
        return np.lexsort((self.place[row], key)) if self.held.single else np.argsort(key, kind="stable")

    def _exact(self, question: np.ndarray, row: np.ndarray) -> np.ndarray:
        out = np.empty(len(question))
        for low in range(0, len(question), PAIRS_AT_ONCE):
            at = slice(low, low + PAIRS_AT_ONCE)
            out[at] = np.einsum("ij,ij->i", self.held.part.rows(row[at]), self.vectors[question[at]])
        return np.round(out, DECIMALS)

    def exact_best(self, question: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of the rows held by cosine, ordered by question."""
        k, found = self.held.k, []
        order = np.argsort(question, kind="stable")
        question, row = question[order], row[order]
        ends = np.flatnonzero(np.append(question[1:] != question[:-1], True)[: len(question)]) + 1
        for low, high in zip(np.append(0, ends[:-1]), ends):
            mine = row[low:high]
            if high - low > k:
                score = self.held.part.unit[mine] @ self.single[question[low]]
                mine = mine[score >= np.partition(score, -k)[-k] - self.held.margin]
            found.append((np.full(len(mine), question[low]), mine))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        question, row = (np.concatenate(column) for column in zip(*found))
        score = self._exact(question, row)
        order = np.lexsort((self.place[row], -score, question))
        question, row, score = question[order], row[order], score[order]
        best = np.arange(len(order)) - np.searchsorted(question, question, side="left") < k
        return question[best], row[best], score[best]
