"""Exact top-k inner products by ball-tree branch and bound, shard by shard.

Vectors are dealt in shards by id. A task builds ball trees over blocks of its shard. For a query q the inner
product with any vector in a ball of centre c and radius r is at most q·c + |q| r; a leaf's bound is the
smallest on its path from the root. Leaves are visited in order of their bound until it falls below the query's
current k-th score, which carries over from tree to tree. All shards start from a k-th score shared before:
that over a seed of `seed_rows` real rows, a lower bound of the final one, so a shard sends back only rows that
may be in the result.

Queries go to the tasks in blocks of at most `query_block` rows, one scan of the vectors per block.

Defined results: rows with a null id, a null vector or a null, NaN or infinite component take no part; equal
rows count once; a query never meets rows with its own id; rows of one id with different vectors are different
candidates and, as queries, have a list each; shorter vectors count as padded with zeros; components beyond
2^62 / length, square-rooted, count as that; ties go to the smaller id; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize
from shelfwise.sources.tables import table

TREE_ROWS = 8192
LEAF_ROWS = 128
QUERY_BLOCK = 16_384
SEED_ROWS = 2048
LAST_ID = np.iinfo(np.int64).max
NO_SCORE = np.iinfo(np.int64).min


class BallTree:
    """Leaves are slices of the reordered rows; `path[leaf]` lists the nodes from the root to the leaf."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.arange(len(ids))
        points = rows.astype(np.float64)
        self.centres, self.radii, self.paths, self.leaves = [], [], [], []
        stack = [(0, len(ids), [])]
        while stack:
            low, high, path = stack.pop()
            own = points[order[low:high]]
            centre = own.mean(axis=0)
            path = [*path, len(self.centres)]
            self.centres.append(centre)
            self.radii.append(math.sqrt(((own - centre) ** 2).sum(axis=1).max()))
            if high - low <= LEAF_ROWS or not self.radii[-1]:
                self.leaves.append((low, high))
                self.paths.append(path)
                continue
            # Split at the median along the line through the two ends of the ball.
            far = own[((own - centre) ** 2).sum(axis=1).argmax()]
            other = own[((own - far) ** 2).sum(axis=1).argmax()]
            middle = (high - low) // 2
            order[low:high] = order[low:high][np.argpartition(own @ (far - other), middle)]
            stack += [(low, low + middle, path), (low + middle, high, path)]
        self.ids, self.rows = ids[order], rows[order]
        self.centres, self.radii = np.stack(self.centres), np.array(self.radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product, (queries, leaves), never below the true one."""
        at_centre = queries @ self.centres.T
        reach = np.sqrt((queries**2).sum(axis=1))[:, None] * self.radii[None, :]
        bound = at_centre + reach + 1e-9 * (np.abs(at_centre) + reach) + 1e-6
        return np.stack([bound[:, path].min(axis=1) for path in self.paths], axis=1)


def inner_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products: by floats while all partial sums are exact, else by integers."""
    if not rows.size or not queries.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    largest = float(np.abs(queries).max()) * float(np.abs(rows).max()) * rows.shape[1]
    if largest < 2**53:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    return queries @ rows.T


class TopK:
    """The k best (score, id) of each query so far; only scores of `floor` or more are of interest."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray):
        self.query_ids, self.queries, self.k, self.floor = query_ids, queries, k, floor
        self.as_float = queries.astype(np.float64)
        self.scores = np.full((len(queries), k), NO_SCORE)
        self.ids = np.full((len(queries), k), LAST_ID)

    def kth(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1], self.floor)

    def offer(self, which: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        scores = inner_products(self.queries[which], rows)
        scores[ids[None, :] == self.query_ids[which][:, None]] = NO_SCORE
        useful = (scores >= self.kth()[which][:, None]) & (scores > NO_SCORE)
        hit = np.flatnonzero(useful.any(axis=1))
        if not len(hit):
            return
        which = which[hit]
        together = np.concatenate([self.scores[which], np.where(useful[hit], scores[hit], NO_SCORE)], axis=1)
        labels = np.concatenate([self.ids[which], np.where(useful[hit], ids[None, :], LAST_ID)], axis=1)
        by_id = np.argsort(labels, axis=1, kind="stable")
        together, labels = np.take_along_axis(together, by_id, 1), np.take_along_axis(labels, by_id, 1)
        best = np.argsort(-np.maximum(together, NO_SCORE + 1), axis=1, kind="stable")[:, : self.k]
        self.scores[which] = np.take_along_axis(together, best, 1)
        self.ids[which] = np.take_along_axis(labels, best, 1)

    def search(self, tree: BallTree) -> None:
        bounds = tree.bounds(self.as_float)
        order = np.argsort(-bounds, axis=1)
        active = np.arange(len(self.queries))
        for step in range(len(tree.leaves)):
            leaf = order[active, step]
            open_ = bounds[active, leaf] >= self.kth()[active]
            active, leaf = active[open_], leaf[open_]
            if not len(active):
                return
            for one in np.unique(leaf):
                low, high = tree.leaves[one]
                self.offer(active[leaf == one], tree.ids[low:high], tree.rows[low:high])


def matrix(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """List column as integer rows, padded with zeros to the longest (at least `width`)."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    if width:
        limit = math.isqrt(2**62 // width)
        np.clip(out, -limit, limit, out=out)
    return out


def _trees(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[BallTree]:
    held, n = [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, TREE_ROWS):
            part = batch.slice(low, TREE_ROWS)
            held.append((part["id"].to_numpy(), matrix(part["vector"], width)))
            n += part.num_rows
            if n >= TREE_ROWS:
                yield _tree(held)
                held, n = [], 0
    if n:
        yield _tree(held)


def _tree(held: list[tuple[np.ndarray, np.ndarray]]) -> BallTree:
    width = max(rows.shape[1] for _, rows in held)
    padded = [np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) for _, rows in held]
    return BallTree(np.concatenate([ids for ids, _ in held]), np.concatenate(padded))


def _same_width(best: TopK, tree: BallTree) -> BallTree:
    """Drop what a query's zeros would multiply: components beyond the queries' width."""
    width = best.queries.shape[1]
    if tree.rows.shape[1] > width:
        return BallTree(tree.ids, tree.rows[:, :width])
    return tree


def _shard_search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, floor = shared.value
        best = TopK(query_ids, queries, k, floor)
        for tree in _trees(batches, queries.shape[1]):
            best.search(_same_width(best, tree))
        row, place = np.nonzero(best.scores > NO_SCORE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row.astype(np.int64)), pa.array(query_ids[row]), pa.array(best.ids[row, place]), pa.array(best.scores[row, place])],
            names=["query_row", "query_id", "id", "score"],
        )

    return run


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, vector): floor(scale * x) of each component; rows that take no part are left out, equal rows are one."""
    usable = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    floors = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    rows = df.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(usable)
    return rows.select(F.col(id_col).cast("bigint").alias("id"), floors.alias("vector")).dropDuplicates()


def top_k(vectors: DataFrame, is_query: Column, k: int, query_block: int = QUERY_BLOCK, seed_rows: int = SEED_ROWS) -> DataFrame:
    """(query_id, rank, id, score): the k highest inner products of every query row with rows of other ids.

    `vectors` has a bigint `id` and an array<bigint> `vector`, without nulls or repeated rows.
    """
    spark = vectors.sparkSession
    questions = vectors.filter(is_query)
    blocks = max(1, -(-questions.count() // query_block))
    seed = vectors.limit(seed_rows).toArrow()
    found = None
    for block in range(blocks):
        own = questions.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()
        query_ids, queries = own["id"].to_numpy(), matrix(own["vector"])
        start = TopK(query_ids, queries, k, np.full(len(queries), NO_SCORE))
        for tree in _trees(seed.to_batches(), queries.shape[1]) if len(queries) else ():
            start.search(_same_width(start, tree))
        shared = spark.sparkContext.broadcast((query_ids, queries, start.scores[:, -1]))  # one block of queries
        part = vectors.mapInArrow(_shard_search(shared, k), "query_row bigint, query_id bigint, id bigint, score bigint")
        part = part.withColumn("query_row", F.col("query_row") + F.lit(block).cast("bigint") * (1 << 40))
        found = part if found is None else found.unionByName(part)
    ranked = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("id").asc())
    ranks = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return ranks.select("query_id", "rank", "id", "score")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialize(integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256), "vectors")
    return top_k(vectors, F.col("id") % 50 == 0, 5).withColumnRenamed("id", "vec_id")


QUERIES = {"op4_exact_topk": op4_exact_topk}
ORACLE = {
    "op4_exact_topk": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
}
