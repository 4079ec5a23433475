"""Threshold similarity join: all pairs of two tables of vectors with a cosine of at least a threshold.

Rows of the cache side go to the cell of the nearest pivot; a cell knows the smallest and largest angle of its
rows to the pivot. An asked row goes to the cells that may hold an answer: by the triangle inequality on angles
the ring between those two angles must be within reach, and so must the border to the asked row's own nearest
pivot. A pair of blocks of a cell is one bounded task. There a pair is first bounded by the product of the
first coordinates plus the product of the norms of the rest, on axes turned so that the first ones carry most;
only pairs whose bound reaches the threshold are scored in full. Both steps only leave out what cannot reach
the threshold, so the result is exact.

Where the vectors have no clusters every cell is within reach: an asked row is then sent once per cell, as in a join of all
blocks, and the bound on the first coordinates does the work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.topk import SCORES_AT_ONCE, id_array
from shelfwise.functions.vectors import matrix
from shelfwise.operators.search import rank_top
from shelfwise.session import materialize, spread_join

# Rows of the cache per cell, and the most cells; their pivots and rings go to every task.
CELL_ROWS = 4096
MAX_CELLS = 4096
# Rows of a block on each side: a task meets one pair of blocks.
ASKED_BLOCK = 1024
CACHE_BLOCK = 32_768
# Rows the axes are turned on; the pivots are the first of them.
TRAIN_ROWS = 4096
# Coordinates of the bounds ahead of a full score.
PREFIXES = (8, 16, 32)
# Pairs that are bounded or scored one by one at a time.
PAIRS_AT_ONCE = 65_536
# A tile of which more than one pair in so many passes all bounds is scored by one product.
DENSE_SHARE = 2
# A tile of which more than one pair in so many passes the first bound has the next ones taken by products too.
OPEN_SHARE = 16
# Scores have six decimals; bounds leave room for their rounding.
DECIMALS = 6
SLACK = 10.0**-DECIMALS


@dataclass(frozen=True)
class Cells:
    """Pivots with the angles of the nearest and farthest row of each cell, and the turned axes."""

    pivots: np.ndarray
    axes: np.ndarray
    near: np.ndarray
    far: np.ndarray

    def reachable(self, rows: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every cell that may hold a row within the angle `reach`."""
        angle = pivot_angles(rows, self.pivots)
        ring = (angle - reach <= self.far) & (angle + reach >= self.near)
        border = angle - angle.min(axis=1, keepdims=True) <= 2 * reach
        return np.nonzero(ring & border)


def pivot_angles(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ pivots.T, -1.0, 1.0))


def _sample(cache: DataFrame) -> np.ndarray:
    """At most TRAIN_ROWS unit vectors, the same ones on every run."""
    picked = cache.orderBy(F.xxhash64("id"), "id").limit(TRAIN_ROWS).select("vector").toArrow()
    return matrix(picked["vector"])


def _assign(cache: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Cache rows with the cell of their nearest pivot and the angle to it."""
    shared = cache.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, angles = [], []
            rows = matrix(batch["vector"])
            step = max(1, SCORES_AT_ONCE // len(shared.value))
            for begin in range(0, len(rows), step):
                angle = pivot_angles(rows[begin : begin + step], shared.value)
                cells.append(angle.argmin(axis=1))
                angles.append(angle.min(axis=1))
            columns = [batch["id"], batch["vector"], pa.array(np.concatenate(cells)), pa.array(np.concatenate(angles))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "vector", "cell", "angle"])

    rows = cache.select("id", "vector")
    return rows.mapInArrow(run, f"{_schema(rows)}, cell bigint, angle double")


def _send(asked: DataFrame, cells: Cells, reach: float) -> DataFrame:
    """Asked rows, once per cell that may hold an answer."""
    shared = asked.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = matrix(batch["vector"])
            # A slice repeats a row up to once per cell, with its vector.
            step = max(1, PAIRS_AT_ONCE // len(shared.value.pivots))
            for begin in range(0, len(rows), step):
                row, cell = shared.value.reachable(rows[begin : begin + step], reach)
                part = batch.select(["id", "vector"]).take(pa.array(row + begin))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int64))], names=["id", "vector", "cell"])

    rows = asked.select("id", "vector")
    return rows.mapInArrow(run, f"{_schema(rows)}, cell bigint")


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)


def _pair_of(pairs: np.ndarray, begin: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(asked row, held row) of places in a tile whose first row is `begin`."""
    row, column = np.divmod(pairs, width)
    return row + begin, column


def bounded_scores(
    asked: np.ndarray, held: np.ndarray, axes: np.ndarray, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int, int]]:
    """(asked row, held row, score) of the pairs that reach the threshold, in parts.

    The last two values of a part are the pairs it bounded and those it scored in full.
    """
    turned_asked, turned_held = asked @ axes, held @ axes
    prefixes = [p for p in PREFIXES if p < asked.shape[1]] or [asked.shape[1]]
    rests = {
        p: tuple(np.sqrt(np.square(side[:, p:]).sum(axis=1)) for side in (turned_asked, turned_held)) for p in prefixes
    }
    low, first = threshold - SLACK, prefixes[0]
    step = max(1, SCORES_AT_ONCE // max(1, len(held)))
    for begin in range(0, len(asked), step):
        end = min(begin + step, len(asked))
        partial = turned_asked[begin:end, :first] @ turned_held[:, :first].T
        open_ = partial + rests[first][0][begin:end, None] * rests[first][1][None, :] >= low
        pairs = np.flatnonzero(open_)
        bounded, scored = (end - begin) * len(held), 0
        # The bounds of a slice of the pairs tell whether they leave out enough; if not, one product is cheaper.
        a, h = _pair_of(pairs[:PAIRS_AT_ONCE], begin, len(held))
        last = prefixes[-1]
        reaching = np.einsum("ij,ij->i", turned_asked[a, :last], turned_held[h, :last]) + rests[last][0][a] * rests[last][1][h] >= low
        if np.count_nonzero(reaching) * len(pairs) * DENSE_SHARE > bounded * len(a) > 0:
            scores = asked[begin:end] @ held.T
            pairs = np.flatnonzero(scores >= low)
            score = np.round(scores.ravel()[pairs], DECIMALS)
            kept = score >= threshold
            yield *_pair_of(pairs[kept], begin, len(held)), score[kept], bounded, bounded
            continue
        left_to_bound = prefixes[1:]
        if len(pairs) * OPEN_SHARE > bounded:
            # Many pairs are left: the next coordinates of all are added by products, not pair by pair.
            for p, q in zip(prefixes, left_to_bound):
                partial += turned_asked[begin:end, p:q] @ turned_held[:, p:q].T
                open_ &= partial + rests[q][0][begin:end, None] * rests[q][1][None, :] >= low
            pairs, left_to_bound = np.flatnonzero(open_), []
        found = []
        for at in range(0, len(pairs), PAIRS_AT_ONCE):
            a, h = _pair_of(pairs[at : at + PAIRS_AT_ONCE], begin, len(held))
            for p in left_to_bound:
                bound = np.einsum("ij,ij->i", turned_asked[a, :p], turned_held[h, :p]) + rests[p][0][a] * rests[p][1][h]
                a, h = a[bound >= low], h[bound >= low]
            score = np.round(np.einsum("ij,ij->i", asked[a], held[h]), DECIMALS)
            scored += len(a)
            kept = score >= threshold
            found.append((a[kept], h[kept], score[kept]))
        parts = [np.concatenate(column) for column in zip(*found)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        yield *parts, bounded, scored


def _block_pairs(asked: DataFrame, cache: DataFrame, threshold: float, cell_rows: int, run, schema: str) -> DataFrame | None:
    """`run(asked rows, held rows, axes)` on every pair of blocks that may hold a pair; None without cache rows."""
    n = cache.count()
    if not n:
        return None
    sample = _sample(cache)
    pivots = np.unique(sample[: min(MAX_CELLS, math.ceil(n / cell_rows))], axis=0)
    axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
    placed = materialize(_assign(cache, pivots), "cells")
    # One row per cell reaches the driver.
    rows_of = F.count(F.lit(1)).alias("n")
    rings = placed.groupBy("cell").agg(rows_of, F.min("angle").alias("near"), F.max("angle").alias("far")).collect()
    near, far = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
    for ring in rings:
        near[ring.cell], far[ring.cell] = ring.near, ring.far
    held = {ring.cell: math.ceil(ring.n / CACHE_BLOCK) for ring in rings}
    # Angles near zero lose half of the digits: cosines apart by 1e-15 differ by 4e-8.
    reach = math.acos(max(-1.0, min(1.0, threshold - SLACK))) + SLACK
    sent = materialize(_send(asked, Cells(pivots, axes, near, far), reach), "sent")
    spark = asked.sparkSession
    blocks = [(r.cell, math.ceil(r.n / ASKED_BLOCK), held[r.cell]) for r in sent.groupBy("cell").agg(rows_of).collect()]
    sizes = F.broadcast(spark.createDataFrame(blocks, "cell bigint, asked_blocks bigint, cache_blocks bigint"))

    def cut(side: DataFrame, own: str, other: str) -> DataFrame:
        return side.join(sizes, "cell").select(
            "id", "vector", "cell", F.pmod(F.xxhash64("id"), F.col(own)).alias(own[:-1]),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)).alias(other[:-1]),
        )

    keys = ["cell", "asked_block", "cache_block"]
    left, right = cut(sent, "asked_blocks", "cache_blocks"), cut(placed.drop("angle"), "cache_blocks", "asked_blocks")
    shared = spark.sparkContext.broadcast(axes)

    def pair(asked_rows: pa.Table, held_rows: pa.Table) -> pa.Table:
        return run(asked_rows, held_rows, shared.value)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, schema)


def similar_pairs(
    asked: DataFrame, cache: DataFrame, threshold: float, best: bool = False, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Pairs (question_id, id, score) with a cosine of at least `threshold`, rounded to six decimals.

    Both sides have `id` and `vector`, free of nulls, zeros and values that are not finite (`infer.dimension_guard`), one row
    per id. Copies should be collapsed before. With `best` only the highest score of each asked row is
    returned, ties to the smaller id; each task then returns at most one row per asked row.
    """
    types = asked.schema["id"].dataType.simpleString(), cache.schema["id"].dataType.simpleString()
    schema = f"question_id {types[0]}, id {types[1]}, score double"

    def run(asked_rows: pa.Table, held_rows: pa.Table, axes: np.ndarray) -> pa.Table:
        parts = [[], [], []]
        if asked_rows.num_rows and held_rows.num_rows:
            ids = id_array(held_rows["id"])
            for a, h, score, *_ in bounded_scores(matrix(asked_rows["vector"]), matrix(held_rows["vector"]), axes, threshold):
                if best:
                    order = np.lexsort((ids[h], -score, a))
                    first = np.unique(a[order], return_index=True)[1]
                    a, h, score = (column[order][first] for column in (a, h, score))
                for part, column in zip(parts, (a, h, score)):
                    part.append(column)
        a, h = (np.concatenate([np.zeros(0, np.int64), *part]).astype(np.int64) for part in parts[:2])
        score = np.concatenate([np.zeros(0), *parts[2]])
        columns = [asked_rows["id"].take(pa.array(a)), held_rows["id"].take(pa.array(h)), pa.array(score)]
        return pa.table(columns, names=["question_id", "id", "score"])

    pairs = _block_pairs(asked, cache, threshold, cell_rows, run, schema)
    if pairs is None:
        return asked.sparkSession.createDataFrame([], schema)
    return rank_top(pairs, 1).drop("rank") if best else pairs


def similar_work(asked: DataFrame, cache: DataFrame, threshold: float, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row: all `pairs`, those the cells left to be `bounded`, those `scored` in full, and those `found`."""

    def run(asked_rows: pa.Table, held_rows: pa.Table, axes: np.ndarray) -> pa.Table:
        total = np.zeros(3, np.int64)
        if asked_rows.num_rows and held_rows.num_rows:
            for a, _, _, bounded, scored in bounded_scores(matrix(asked_rows["vector"]), matrix(held_rows["vector"]), axes, threshold):
                total += (bounded, scored, len(a))
        return pa.table({name: pa.array([n]) for name, n in zip(("bounded", "scored", "found"), total)})

    spark = asked.sparkSession
    schema = "bounded bigint, scored bigint, found bigint"
    work = _block_pairs(asked, cache, threshold, cell_rows, run, schema)
    work = spark.createDataFrame([], schema) if work is None else work
    pairs = asked.count() * cache.count()
    return work.agg(
        F.lit(pairs).cast("bigint").alias("pairs"),
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in ("bounded", "scored", "found")],
    )


def semantic_cache(asked: DataFrame, cache: DataFrame, threshold: float, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Exact, near or miss for every asked row, with the cached row that serves it.

    Both sides have `id`, `content_hash` and `vector`. Each distinct content is looked up once:
    by hash, then by the best of the pairs that reach the threshold; its copies get the same result.
    """
    known = cache.groupBy("content_hash").agg(F.min("id").alias("exact_id"))
    distinct = asked.groupBy("content_hash").agg(F.min("id").alias("id"), F.min_by("vector", "id").alias("vector"))
    new = distinct.join(known, "content_hash", "left_anti")
    once = cache.groupBy("content_hash").agg(F.min("id").alias("id"), F.min_by("vector", "id").alias("vector"))
    near = similar_pairs(new, once, threshold, best=True, cell_rows=cell_rows).select(F.col("question_id").alias("id"), F.col("id").alias("near_id"), F.col("score").alias("near_score"))
    served = distinct.drop("vector").join(known, "content_hash", "left").join(near, "id", "left").select(
        "content_hash",
        F.when(F.col("exact_id").isNotNull(), "exact").when(F.col("near_id").isNotNull(), "near").otherwise("miss").alias("outcome"),
        F.coalesce("exact_id", "near_id").alias("cached_id"),
        F.when(F.col("exact_id").isNotNull(), 1.0).otherwise(F.col("near_score")).alias("score"),
    )
    copies = asked.select("id", "content_hash")
    return spread_join(copies, served, ["content_hash"], ["id"], "left").drop("content_hash")
