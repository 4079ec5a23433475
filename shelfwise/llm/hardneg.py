"""Hard negatives by cover trees over norm-augmented candidates.

An extra coordinate gives all candidates of a shard the same norm, so that the order by inner product with an
anchor is the order by angle on a sphere. A cover tree halves its covering radius from level to level: the
centres of a level are rows, lie further apart than its radius and cover their descendants. The angle between an
anchor and a centre, with the angle of the centre's covering radius added or taken away, bounds the inner products
of all descendants from both sides. The descent takes the node with the highest bound first; it skips nodes that lie
outside an anchor's window, below its current k-th score, or that hold rows of unwanted labels only. Centres and
leaves are verified by exact integer products.

A search is a set of requests: an anchor, wanted labels (its own or all others), a window of scores and a number of
rows. Positives are requests without a window; every positive gives a request for the negatives in its window. Rows
are packed into trees where they are read, requests into blocks by a hash of the anchor, and every pair of a tree and
a block is one bounded unit of work. Blocks start from the k-th scores of a seed of `seed_rows` rows, lower bounds of
the final ones, so that little more than the result is sent back.

Defined results: rows with a null id, label or vector, or with a null, NaN or infinite component take no part; equal
rows count once; rows with the id of the anchor are neither its positives nor its negatives; rows of one id with
different vectors or labels are different rows and, as anchors, have results each; shorter vectors count as padded
with zeros; components and scores beyond a long count as its ends; ties go to the smaller id; a positive without
negatives in its window, and an empty table, give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize
from shelfwise.sources.tables import table

TREE_ROWS = 2048
LEAF_ROWS = 16
CHILDREN_AT_ONCE = 512
BLOCK_REQUESTS = 2048
SEED_ROWS = 2048
# Blocks of requests go to every task up to this size.
BROADCAST_BYTES = 32 * 1024 * 1024
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products as longs: by floats while all partial sums are exact, else by Python's integers."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    if float(np.abs(left.astype(float)).max()) * float(np.abs(right.astype(float)).max()) * left.shape[1] < 2**53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    exact = left.astype(object) @ right.T.astype(object)
    return np.minimum(np.maximum(exact, int(LEAST)), int(MOST)).astype(np.int64)


def integer_matrix(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """List column as integer rows, padded with zeros to the longest (at least `width`)."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _padded(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


class CoverTree:
    """Entries in breadth-first order: a row as centre, the covering radius as an angle, and the range of its children.

    A centre is the first of its own children (nesting); it is `fresh` where it appears first.
    """

    FIELDS = ("point", "angle", "low", "high", "fresh", "least_label", "most_label")

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, entries: dict[str, np.ndarray] | None = None):
        self.ids, self.labels, self.rows = ids, labels, rows
        points = rows.astype(np.float64)
        squares = (points**2).sum(axis=1)
        self.norm = float(np.sqrt(squares.max(initial=0.0)))
        if entries is None:
            entries = self._build(points, squares)
        for name in self.FIELDS:
            setattr(self, name, entries[name])

    def _build(self, points: np.ndarray, squares: np.ndarray) -> dict[str, np.ndarray]:
        extra = np.sqrt(np.maximum(self.norm**2 - squares, 0.0))  # the coordinate that makes all norms equal
        apart = squares[:, None] + squares[None, :] - 2 * (points @ points.T) + (extra[:, None] - extra[None, :]) ** 2
        apart = np.sqrt(np.maximum(apart, 0.0, out=apart), out=apart)
        point, members, low, high, fresh = [int(apart.max(axis=1).argmin())], [np.arange(len(points))], [0], [0], [True]
        radius, least, most, at = [], [], [], 0
        while at < len(point):
            centre, own = point[at], members[at]
            far = apart[centre, own]
            radius.append(float(far.max()))
            least.append(self.labels[own].min())
            most.append(self.labels[own].max())
            members[at] = None
            if len(own) > 1:
                others = own[own != centre]
                if len(own) <= LEAF_ROWS or not radius[-1]:
                    children = [(centre, np.array([centre]))] + [(int(p), np.array([p])) for p in others]
                else:
                    limit, left, children = radius[-1] / 2, others, []
                    pick = centre
                    while True:
                        near = apart[pick, left] <= limit
                        children.append((pick, np.append(left[near], pick)))
                        left = left[~near]
                        if not len(left):
                            break
                        pick, left = int(left[0]), left[1:]
                low[at], high[at] = len(point), len(point) + len(children)
                for n, (p, group) in enumerate(children):
                    point.append(p)
                    members.append(group)
                    low.append(0)
                    high.append(0)
                    fresh.append(n > 0)
            at += 1
        # Half a chord over the radius of the sphere is the sine of half the angle; a little more for rounding.
        reach = np.array(radius)
        angle = 2 * np.arcsin(np.minimum(1.0, reach / (2 * self.norm))) + 1e-6 if self.norm else np.zeros(len(point))
        return {
            "point": np.array(point), "angle": np.minimum(angle, np.pi), "low": np.array(low), "high": np.array(high),
            "fresh": np.array(fresh), "least_label": np.array(least, np.int64), "most_label": np.array(most, np.int64),
        }

    def bounds(self, entries: np.ndarray, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) inner product below each entry, from the scores of the centres with anchors of the given lengths."""
        scale = lengths[:, None] * self.norm
        turned = np.arccos(np.clip(np.divide(scores, scale, out=np.zeros(scores.shape), where=scale > 0), -1, 1))
        angle, slack = self.angle[entries][None, :], 1e-9 * scale + 1e-6
        least = scale * np.cos(np.minimum(turned + angle, np.pi)) - slack
        return least, scale * np.cos(np.maximum(turned - angle, 0.0)) + slack


class Requests:
    """Requests of one block, and the best rows found for each."""

    def __init__(self, anchor: np.ndarray, vectors: np.ndarray, own_id: np.ndarray, label: np.ndarray, low: np.ndarray,
                 high: np.ndarray, floor: np.ndarray, k: int, same: bool):
        _, first, self.of = np.unique(anchor, return_index=True, return_inverse=True)
        self.anchors = vectors[first]  # requests of one anchor share its products
        self.lengths = np.sqrt((self.anchors.astype(np.float64) ** 2).sum(axis=1))
        self.own_id, self.label, self.high, self.k, self.same = own_id, label, high, k, same
        self.kth = np.maximum(low, floor)
        self.scores = np.full((len(low), k), LEAST)
        self.ids = np.full((len(low), k), MOST)
        self.n = np.zeros(len(low), np.int64)
        self.scored = 0

    def wanted(self, which: np.ndarray, labels: np.ndarray) -> np.ndarray:
        return (self.label[which][:, None] == labels[None, :]) == self.same

    def offer(self, which: np.ndarray, ids: np.ndarray, labels: np.ndarray, scores: np.ndarray) -> None:
        ok = (scores >= self.kth[which][:, None]) & (scores <= self.high[which][:, None])
        ok &= self.wanted(which, labels) & (ids[None, :] != self.own_id[which][:, None])
        row, column = np.nonzero(ok)
        if not len(row):
            return
        hit = np.unique(row)
        who = which[hit]
        held_row, held_place = np.nonzero(np.arange(self.k)[None, :] < self.n[who][:, None])
        request = np.concatenate([who[held_row], which[row]])
        score = np.concatenate([self.scores[who][held_row, held_place], scores[row, column]])
        label_id = np.concatenate([self.ids[who][held_row, held_place], ids[column]])
        order = np.lexsort((label_id, ~score, request))  # ~x falls as x rises, without overflow
        request, score, label_id = request[order], score[order], label_id[order]
        place = np.arange(len(request)) - np.searchsorted(request, request)
        best = place < self.k
        request, score, label_id, place = request[best], score[best], label_id[best], place[best]
        self.scores[request, place], self.ids[request, place] = score, label_id
        self.n[who] = np.bincount(request, minlength=len(self.n))[who]
        full = who[self.n[who] == self.k]
        self.kth[full] = np.maximum(self.kth[full], self.scores[full, -1])

    def search(self, tree: CoverTree) -> None:
        """Best-first descent; a node is visited once, for all requests that may find something below it."""
        width = max(self.anchors.shape[1], tree.rows.shape[1])
        anchors, rows = _padded(self.anchors, width), _padded(tree.rows, width)
        waiting = [(-np.inf, 0, np.arange(len(self.kth)), None)]  # the root is its own first child
        open_root = True
        while waiting:
            _, entry, which, bound = heapq.heappop(waiting)
            if bound is not None:
                which = which[bound >= self.kth[which]]
                if not len(which):
                    continue
            first, last = (0, 1) if open_root else (tree.low[entry], tree.high[entry])
            open_root = False
            for low in range(first, last, CHILDREN_AT_ONCE):
                children = np.arange(low, min(low + CHILDREN_AT_ONCE, last))
                points = tree.point[children]
                used, of = np.unique(self.of[which], return_inverse=True)
                products = inner_products(anchors[used], rows[points])
                self.scored += products.size
                scores = products[of]
                new = tree.fresh[children]
                self.offer(which, tree.ids[points[new]], tree.labels[points[new]], scores[:, new])
                inner = tree.high[children] > tree.low[children]
                if not inner.any():
                    continue
                inside = children[inner]
                least, most = (part[of] for part in tree.bounds(inside, products[:, inner].astype(np.float64), self.lengths[used]))
                pure = tree.least_label[inside] == tree.most_label[inside]
                useful = (most >= self.kth[which][:, None]) & (least <= self.high[which][:, None])
                useful &= ~pure[None, :] | self.wanted(which, tree.least_label[inside])
                for n in np.flatnonzero(useful.any(axis=0)):
                    some = useful[:, n]
                    heapq.heappush(waiting, (-float(most[some, n].max()), int(inside[n]), which[some], most[some, n]))


_TREE = "tree bigint, width int, ids array<bigint>, labels array<bigint>, vectors array<bigint>, point array<int>, angle array<double>, low array<int>, high array<int>, fresh array<boolean>, least_label array<bigint>, most_label array<bigint>"
_BLOCK = "block bigint, r_width int, rid array<bigint>, anchor array<bigint>, anchor_id array<bigint>, label array<bigint>, r_low array<bigint>, r_high array<bigint>, floor array<bigint>, r_vectors array<bigint>"


def _one(values) -> pa.Array:
    """A list column of one row."""
    return pa.array([np.asarray(values)])


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of up to `rows` rows at a time."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def joined(parts):
        width = max(p[2].shape[1] for p in parts)
        return tuple(np.concatenate(x) for x in ([p[0] for p in parts], [p[1] for p in parts], [_padded(p[2], width) for p in parts]))

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows - sum(len(p[0]) for p in held))
            held.append((part["id"].to_numpy(), part["label"].to_numpy(), integer_matrix(part["vector"])))
            at += part.num_rows
            if sum(len(p[0]) for p in held) == rows:
                yield joined(held)
                held = []
    if held:
        yield joined(held)


def _planter(tree_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, (ids, labels, vectors) in enumerate(_chunks(batches, tree_rows)):
            tree = CoverTree(ids, labels.astype(np.int64), vectors)
            columns = [pa.array([n], pa.int64()), pa.array([vectors.shape[1]], pa.int32()), _one(ids), _one(tree.labels), _one(vectors.ravel())]
            for name in CoverTree.FIELDS:
                values = getattr(tree, name)
                columns.append(_one(values.astype(np.int32) if name in ("point", "low", "high") else values))
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "width", "ids", "labels", "vectors", *CoverTree.FIELDS])

    return run


def _numbers(batch: pa.RecordBatch | pa.Table, name: str, i: int) -> np.ndarray:
    return batch[name][i].values.to_numpy(zero_copy_only=False)


def _tree_of(batch: pa.RecordBatch, i: int) -> CoverTree:
    ids = _numbers(batch, "ids", i)
    rows = _numbers(batch, "vectors", i).reshape(len(ids), -1)
    return CoverTree(ids, _numbers(batch, "labels", i), rows, {name: _numbers(batch, name, i) for name in CoverTree.FIELDS})


def _packer(seed, k: int, same: bool):
    """One row per block of requests, each with the k-th score it reaches over the seed rows."""

    def pack(rows: pa.Table) -> pa.Table:
        vectors = integer_matrix(rows["vector"])
        numbers = {c: rows[c].to_numpy() for c in ("rid", "anchor", "anchor_id", "label", "low", "high")}
        none = np.full(rows.num_rows, LEAST)
        found = Requests(numbers["anchor"], vectors, numbers["anchor_id"], numbers["label"], numbers["low"], numbers["high"], none, k, same)
        ids, labels, seed_rows = seed.value
        if len(ids):
            found.search(CoverTree(ids, labels, seed_rows))
        columns = [pa.array([rows["block"][0].as_py()], pa.int64()), pa.array([vectors.shape[1]], pa.int32())]
        columns += [_one(numbers[c]) for c in ("rid", "anchor", "anchor_id", "label", "low", "high")]
        columns += [_one(found.scores[:, -1]), _one(vectors.ravel())]
        return pa.Table.from_arrays(columns, names=["block", "r_width", "rid", "anchor", "anchor_id", "label", "r_low", "r_high", "floor", "r_vectors"])

    return pack


def _searcher(k: int, same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = {c: _numbers(batch, c, i) for c in ("rid", "anchor", "anchor_id", "label", "r_low", "r_high", "floor")}
                vectors = _numbers(batch, "r_vectors", i).reshape(len(own["rid"]), -1)
                found = Requests(own["anchor"], vectors, own["anchor_id"], own["label"], own["r_low"], own["r_high"], own["floor"], k, same)
                found.search(_tree_of(batch, i))
                row, place = np.nonzero(np.arange(k)[None, :] < found.n[:, None])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own["rid"][row]), pa.array(found.ids[row, place]), pa.array(found.scores[row, place])], names=["rid", "id", "score"]
                )

    return run


def plant(rows: DataFrame, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Cover trees of `rows` (id, label, vector: longs), packed where the rows are read: a table of its own."""
    return materialize(rows.select("id", "label", "vector").mapInArrow(_planter(tree_rows), _TREE), "trees")


def search(
    trees: DataFrame, requests: DataFrame, seed_rows: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, same: bool,
    block_requests: int = BLOCK_REQUESTS, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(rid, rank, id, score): the k best rows of each request.

    `requests` has rid, anchor (a key of the anchor's row), anchor_id, label, low, high and vector.
    """
    spark = trees.sparkSession
    size = requests.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    blocks = max(1, -(-size.n // block_requests))
    dealt = requests.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
    packed = dealt.groupBy("block").applyInArrow(_packer(spark.sparkContext.broadcast(seed_rows), k, same), _BLOCK)
    packed = materialize(packed, "blocks")
    grid = trees.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    small = size.n * ((size.width or 0) + 8) * 8 <= broadcast_bytes  # what the blocks hold
    found = grid.join(F.broadcast(packed) if small else packed, "block").mapInArrow(_searcher(k, same), "rid bigint, id bigint, score bigint")
    order = Window.partitionBy("rid").orderBy(F.col("score").desc(), F.col("id").asc())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("rid", "rank", "id", "score")


def labelled_integers(df: DataFrame, id_col: str, label: Column, vector_col: str, scale: int) -> DataFrame:
    """(id, label, vector): floor(scale * x) of each component; rows that take no part are left out, equal rows are one."""
    usable = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    floors = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    rows = df.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(usable)
    return rows.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), floors.alias("vector")).filter("label IS NOT NULL").dropDuplicates()


def _part(value: Column, of: int, share: int, up: bool = False) -> Column:
    """value * share / of, rounded down or up, without overflow; for values and shares of 0 or more, shares of `of` at most."""
    rest = F.pmod(value, F.lit(of).cast("bigint"))
    return F.call_function("div", value - rest, F.lit(of)) * share + F.call_function("div", rest * share + (of - 1 if up else 0), F.lit(of))


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int, negatives: int, low_percent: int, high_percent: int,
    tree_rows: int = TREE_ROWS, seed_rows: int = SEED_ROWS, **settings,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    `rows` has id, label and vector (longs), without nulls or repeated rows. Negatives have another label than the
    anchor and a score of low_percent to high_percent of the positive's.
    """
    trees = plant(rows, tree_rows)
    taken = rows.limit(seed_rows).toArrow()  # bounded
    seed = (taken["id"].to_numpy(), taken["label"].to_numpy(), integer_matrix(taken["vector"]))
    anchors = materialize(rows.filter(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    ends = {"low": F.lit(int(LEAST)).cast("bigint"), "high": F.lit(int(MOST)).cast("bigint")}
    first = anchors.select(F.col("anchor").alias("rid"), "anchor", F.col("id").alias("anchor_id"), "label", "vector").withColumns(ends)
    liked = search(trees, first, seed, positives, True, **settings).select(F.col("rid").alias("anchor"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    score = F.greatest("positive_score", F.lit(0).cast("bigint"))
    windows = liked.withColumns({"low": _part(score, 100, low_percent, up=True), "high": _part(score, 100, high_percent)})
    windows = windows.filter("positive_score >= 0 AND low <= high")  # a window below zero is empty
    windows = materialize(windows.join(anchors, "anchor").withColumnRenamed("id", "anchor_id").withColumn("rid", F.monotonically_increasing_id()), "windows")
    found = search(trees, windows, seed, negatives, False, **settings)
    named = windows.select("rid", "anchor_id", "positive_id", "positive_score")
    return found.join(named, "rid").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = materialize(labelled_integers(table(spark, sf_dir, "embeddings"), "vec_id", changed, "embedding", 256), "rows")
    return hard_negatives(rows, F.col("id") % 50 == 0, 5, 3, 50, 95)


QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLE = {
    "op13_hard_negatives": """
WITH v AS MATERIALIZED (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS r
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 3
"""
}
