"""Running top-k of one task, shared by the vector and keyword kernels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Scores held at once: 16 MB of doubles, and a few copies of them.
SCORES_AT_ONCE = 2 * 1024 * 1024


def id_array(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Ids as a sortable array: integers or text."""
    return np.asarray(column.to_pylist())


def best_k(questions: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best rows of every question; ties go to the smaller id."""
    order = np.lexsort((ids, -scores, questions))
    sorted_q = questions[order]
    first = np.searchsorted(sorted_q, sorted_q, side="left")
    return order[np.arange(len(order)) - first < k]


class BestK:
    """At most k rows per question are held, whatever the task reads.

    With `best_per_id` the rows of one id are one candidate, with the best of their scores.
    """

    def __init__(self, question_ids: np.ndarray, k: int, best_per_id: bool = False):
        self.question_ids, self.k, self.best_per_id = question_ids, k, best_per_id
        self.held: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def offer(self, ids: np.ndarray, scores: np.ndarray, asked: np.ndarray) -> None:
        """Take a block of scores, one row per id and one column per asked question; -inf, inf and NaN are no match."""
        scores = np.where(np.isfinite(scores), scores, -np.inf)
        if self.best_per_id and len(ids):
            ids, place = np.unique(ids, return_inverse=True)
            order = np.argsort(place, kind="stable")
            scores = np.maximum.reduceat(scores[order], np.searchsorted(place[order], np.arange(len(ids))), axis=0)
        floor = np.partition(scores, -self.k, axis=0)[-self.k] if len(ids) > self.k else -np.inf
        row, column = np.nonzero((scores >= floor) & np.isfinite(scores))
        self.offer_rows(asked[column], ids[row], scores[row, column])

    def offer_rows(self, questions: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Take scores as matching (question, id) rows."""
        found = (questions, ids, scores)
        if self.held is not None:
            found = tuple(np.concatenate(pair) for pair in zip(self.held, found))
        if self.best_per_id and len(found[0]):
            questions, ids, scores = (part[np.lexsort((-found[2], found[1], found[0]))] for part in found)
            first = np.append(True, (questions[1:] != questions[:-1]) | (ids[1:] != ids[:-1]))
            found = (questions[first], ids[first], scores[first])
        keep = best_k(*found, self.k)
        self.held = tuple(part[keep] for part in found)

    def batch(self, id_type: pa.DataType, question_type: pa.DataType) -> pa.RecordBatch:
        questions, ids, scores = self.held if self.held is not None else (np.array([], int), [], [])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.question_ids[questions].tolist(), question_type),
                pa.array(list(ids), id_type),
                pa.array(list(scores), pa.float64()),
            ],
            names=["question_id", "id", "score"],
        )
