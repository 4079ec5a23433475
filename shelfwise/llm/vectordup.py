"""Near-duplicate vectors by cross-polytope hashing, verified.

1. Equal vectors are one node; copies are never paired.
2. A hash turns a vector by three rounds of random signs and a fast Hadamard transform and names the nearest
   vertex of the cross-polytope: the coordinate of largest size, with its sign. A table joins `hashes` of them, so
   many that a bucket of unrelated vectors stays small at the number of nodes there is. Each vector goes to the
   `probes` buckets it is nearest to, and a pair meets where any two of its probes agree. The chance of that at
   the threshold is simulated for the width at hand, and gives the number of tables for the target recall.
3. Inside a bucket, 128-bit sign sketches sort out pairs far below the threshold, so that buckets do not chain
   unrelated vectors together; what remains goes on as a forest, never as pairs. A bucket of more than
   `bucket_nodes` nodes is a group of near copies: it becomes a star, by an aggregate and a join.
4. Components of these edges are the candidate groups. Their vectors are fetched once and compared in double
   precision, all pairs of a group, in tasks of bounded size: a large group is cut in blocks, and the pairs of
   blocks that share a bucket are its tasks. A task sends back a row per node, never the pairs.
5. Components of the verified links are the classes.

Only ids, bucket codes and sketches are shuffled by bucket. Work is linear but for groups of different near copies,
whose links must be counted: those take one product per pair of blocks.

Defined results: vectors that are null or zero or hold a null, NaN or infinite component link with nothing and are
their own component; shorter vectors count as padded with zeros; rows with equal vectors link with each other, also
if their ids are equal; a component's id is its smallest id that is not null; a row without an id takes part, its
component may be null and it is kept then; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.graph import components
from shelfwise.llm.ordering import running_total
from shelfwise.llm.textbytes import mix
from shelfwise.session import fits, materialize
from shelfwise.sources.tables import table

THRESHOLD = 0.9
RECALL = 0.999
PROBES = 8
# Unrelated nodes a bucket holds on average, at most.
BUCKET_LOAD = 64
BUCKET_NODES = 2048
BLOCK_NODES = 1024
# Smaller groups are one task; larger ones are spread over the pairs of so many blocks, or more.
SPREAD_NODES = 128
GROUP_BLOCKS = 8
SKETCH_BITS = 128
# Chance that a pair at the threshold fails the sketch.
SKETCH_LOSS = 1e-4
ROWS_AT_ONCE = 4096
PAIRS_AT_ONCE = 1 << 22
SIMULATED = 2000


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep its length."""
    n, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(n, -1, 2, half)
        rows = np.concatenate([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return rows / math.sqrt(width)


def rotate(rows: np.ndarray, seed: int) -> np.ndarray:
    """A pseudo-random rotation: three rounds of random signs and a Hadamard transform."""
    random = np.random.default_rng(seed)
    for _ in range(3):
        rows = hadamard(rows * random.choice([-1.0, 1.0], rows.shape[1]))
    return rows


def _best(loss: np.ndarray, code: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(loss, axis=1, kind="stable")[:, :probes]
    return np.take_along_axis(loss, order, 1), np.take_along_axis(code, order, 1)


def bucket_codes(rows: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """(rows, tables * probes): the buckets each unit vector is nearest to, by the squared distances its vertices lose."""
    vertices = 2 * rows.shape[1]
    out = []
    for t in range(tables):
        loss, code = np.zeros((len(rows), 1)), np.zeros((len(rows), 1), np.uint64)
        for h in range(hashes):
            turned = rotate(rows, 1 + t * 64 + h)
            reach = np.concatenate([turned, -turned], axis=1)
            own_loss, vertex = _best(reach.max(axis=1, keepdims=True) - reach, np.broadcast_to(np.arange(vertices, dtype=np.uint64), reach.shape), probes)
            loss = (loss[:, :, None] + own_loss[:, None, :] ** 2).reshape(len(rows), -1)
            code = (code[:, :, None] * np.uint64(vertices) + vertex[:, None, :]).reshape(len(rows), -1)
            loss, code = _best(loss, code, probes)
        out.append(mix(code + mix(np.full(1, t + 1, np.uint64))))
    return np.concatenate(out, axis=1).view(np.int64)


def choose_hashes(nodes: int, width: int, probes: int = PROBES, load: int = BUCKET_LOAD) -> int:
    """The fewest hashes a table needs to keep buckets of unrelated vectors small; a code has 64 bits at most."""
    hashes = 1
    while nodes * probes / (2 * width) ** hashes > load and (2 * width) ** (hashes + 1) < 2**64:
        hashes += 1
    return hashes


def choose_tables(width: int, hashes: int, threshold: float, recall: float = RECALL, probes: int = PROBES) -> int:
    """Tables that reach the recall at the threshold, from simulated pairs of that cosine."""
    random = np.random.default_rng(width)
    one, other = random.normal(size=(2, SIMULATED, width))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (one * other).sum(axis=1, keepdims=True) * one
    other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-300)
    other = threshold * one + math.sqrt(1 - threshold**2) * other
    codes = [bucket_codes(rows, 1, hashes, probes) for rows in (one, other)]
    missed = 1 - (codes[0][:, :, None] == codes[1][:, None, :]).any(axis=(1, 2)).mean()
    return max(1, math.ceil(math.log(1 - recall) / math.log(min(max(missed, 1e-12), 1 - 1e-3))))


def sketch_limit(threshold: float) -> int:
    """Most bits in which the sketches of a pair at the threshold differ, but for a chance of SKETCH_LOSS."""
    chance, total = math.acos(threshold) / math.pi, 0.0
    for bits in range(SKETCH_BITS + 1):
        total += math.comb(SKETCH_BITS, bits) * chance**bits * (1 - chance) ** (SKETCH_BITS - bits)
        if total >= 1 - SKETCH_LOSS:
            return bits
    return SKETCH_BITS


def sketches(rows: np.ndarray) -> np.ndarray:
    """(rows, 2): signs of random projections as two 64-bit numbers."""
    planes = np.random.default_rng(0x51C7).standard_normal((rows.shape[1], SKETCH_BITS))
    return np.packbits(rows @ planes > 0, axis=1).view(np.uint64)


def unit_rows(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column in double precision, padded with zeros and scaled to length one."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out /= np.abs(out).max(axis=1, keepdims=True, initial=1e-300)  # no overflow in the squares
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _signer(width: int, tables: int, hashes: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(low, ROWS_AT_ONCE)
                rows = unit_rows(batch["vector"], width)
                codes, marks = bucket_codes(rows, tables, hashes, probes), sketches(rows).view(np.int64)
                ends = pa.array(np.arange(len(rows) + 1) * codes.shape[1], pa.int32())
                listed = pa.ListArray.from_arrays(ends, pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch["node"], listed, pa.array(marks[:, 0]), pa.array(marks[:, 1])], names=["node", "codes", "s1", "s2"]
                )

    return run


def _reached(n: int, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The smallest place each of n places is connected with."""
    label = np.arange(n)
    while len(one):
        before = label.copy()
        least = np.minimum(label[one], label[other])
        np.minimum.at(label, one, least)
        np.minimum.at(label, other, least)
        np.minimum.at(label, before, label)  # what a place was connected with follows it
        label = label[label]
        if (label == before).all():
            break
    return label


def _bucket_forest(limit: int):
    """Streams rows sorted by bucket and connects, inside each, the nodes whose sketches are close."""

    def forest(code: np.ndarray, node: np.ndarray, s1: np.ndarray, s2: np.ndarray) -> Iterator[pa.RecordBatch]:
        ends = np.searchsorted(code, code, side="right")
        partners = ends - np.arange(len(code)) - 1
        total = np.cumsum(partners)
        low = 0
        while low < len(code):
            high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + PAIRS_AT_ONCE, side="right")))
            some = partners[low:high]
            one = np.repeat(np.arange(low, high), some)
            other = one + 1 + np.arange(len(one)) - np.repeat(np.cumsum(some) - some, some)
            close = np.bitwise_count(s1[one] ^ s1[other]).astype(np.int16) + np.bitwise_count(s2[one] ^ s2[other]) <= limit
            one, other = one[close], other[close]
            places, packed = np.unique(np.concatenate([one, other]), return_inverse=True)
            label = _reached(len(places), packed[: len(one)], packed[len(one) :])
            moved = np.flatnonzero(label != np.arange(len(places)))
            yield pa.RecordBatch.from_arrays([pa.array(node[places[moved]]), pa.array(node[places[label[moved]]])], names=["u", "v"])
            low = high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = [batch[c].to_numpy() for c in ("code", "node")] + [batch[c].to_numpy().view(np.uint64) for c in ("s1", "s2")]
            rows = [np.concatenate(pair) for pair in zip(rest, rows)] if rest else rows
            if not len(rows[0]):
                continue
            last = int(np.searchsorted(rows[0], rows[0][-1]))  # the last bucket may go on
            yield from forest(*[r[:last] for r in rows])
            rest = [r[last:] for r in rows]
        if rest:
            yield from forest(*rest)

    return run


def candidate_edges(signed: DataFrame, threshold: float, bucket_nodes: int) -> DataFrame:
    """(u, v): a forest of each bucket; `signed` has node, codes and the sketch."""
    coded = signed.select(F.explode("codes").alias("code"), "node", "s1", "s2")
    held = coded.groupBy("code").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("lead")).filter("m > 1")
    held = materialize(held, "buckets")
    heavy = held.filter(F.col("m") > bucket_nodes).select("code", "lead")
    some = held.filter(F.col("m") <= bucket_nodes).select("code")
    stars = coded.join(F.broadcast(heavy) if fits(heavy) else heavy, "code").filter("node <> lead").select(F.col("node").alias("u"), F.col("lead").alias("v"))
    met = coded.join(F.broadcast(some) if fits(some) else some, "code", "left_semi")
    dealt = met.repartition("code").sortWithinPartitions("code")
    forests = dealt.mapInArrow(_bucket_forest(sketch_limit(threshold)), "u bigint, v bigint")
    return stars.unionByName(forests).distinct()


def _place(members: DataFrame, signed: DataFrame, block_nodes: int) -> tuple[DataFrame, DataFrame | None]:
    """Candidate nodes with their block, and the tasks (root, block, low, high) of groups of several blocks.

    A group of more than SPREAD_NODES is cut in GROUP_BLOCKS blocks, or in more of at most `block_nodes`.
    """
    least = min(SPREAD_NODES, block_nodes)
    size = F.least(F.lit(block_nodes), F.greatest(F.lit(least), F.ceil(F.col("m") / GROUP_BLOCKS)))
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("m")).withColumn("size", size)
    sized = members.join(sizes, "root")
    small = sized.filter(F.col("m") <= least).select("node", "root", F.lit(0).alias("block"))
    large = sized.filter(F.col("m") > least)
    if large.isEmpty():
        return small, None
    near = signed.select("node", "codes", F.element_at("codes", 1).alias("near"))
    ordered = large.join(near, "node").withColumn("one", F.lit(1).cast("bigint"))
    placed = running_total(ordered, [F.col(c).asc() for c in ("root", "near", "node")], "one")
    starts = placed.groupBy("root").agg(F.min("before").alias("start"))
    placed = placed.join(starts, "root").withColumn("block", F.floor((F.col("before") - F.col("start")) / F.col("size")).cast("int"))
    placed = materialize(placed.select("node", "root", "block", "codes"), "placed")
    held = placed.select("root", "block", F.explode("codes").alias("code")).distinct()
    other = held.select("root", F.col("block").alias("high"), "code")
    shared = held.withColumnRenamed("block", "low").join(other, ["root", "code"]).filter("low <= high").select("root", "low", "high").distinct()
    tasks = shared.withColumn("block", F.explode(F.array_distinct(F.array("low", "high"))))
    return small.unionByName(placed.select("node", "root", "block")), materialize(tasks, "tasks")


def _verifier(width: int, threshold: float):
    """Streams rows sorted by task and compares the vectors of one task after another."""
    names = ("root", "low", "high", "block", "node", "copies")

    def finish(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> pa.RecordBatch:
        _, low, high, block, node, copies = (np.concatenate(column) for column in zip(*[p[0] for p in parts]))
        rows = np.concatenate([p[1] for p in parts])
        order = np.argsort(node)
        block, node, copies, rows = block[order], node[order], copies[order], rows[order]
        linked = rows @ rows.T >= threshold
        np.fill_diagonal(linked, False)
        if low[0] != high[0]:  # pairs inside a block have a task of their own
            linked &= block[:, None] != block[None, :]
        label = _reached(len(node), *np.nonzero(np.triu(linked)))
        docs = linked @ copies
        return pa.RecordBatch.from_arrays(
            [pa.array(node), pa.array(linked.sum(axis=1).astype(np.int64)), pa.array(docs.astype(np.int64)), pa.array(node[label])],
            names=["node", "texts", "docs", "near"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, parts = None, []
        for batch in batches:
            keys, rows = [batch[c].to_numpy() for c in names], unit_rows(batch["vector"], width)
            change = np.flatnonzero((np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0) | (np.diff(keys[2]) != 0)) + 1
            for low, high in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
                if low == high:
                    continue
                own = tuple(int(k[low]) for k in keys[:3])
                if own != task and parts:
                    yield finish(parts)
                    parts = []
                task = own
                parts.append(([k[low:high] for k in keys], rows[low:high]))
        if parts:
            yield finish(parts)

    return run


def _verified(nodes: DataFrame, members: DataFrame, tasks: DataFrame | None, width: int, threshold: float) -> DataFrame:
    """(node, texts, docs, near) per node and task."""
    named = F.broadcast(members) if fits(members) else members
    held = nodes.select("node", "copies", "vector").join(named, "node")
    if tasks is None:
        dealt = held.withColumns({"low": F.lit(0), "high": F.lit(0)})
    else:  # a group of one block has no entry
        dealt = held.join(F.broadcast(tasks) if fits(tasks) else tasks, ["root", "block"], "left").na.fill(0, ["low", "high"])
    dealt = dealt.select("root", "low", "high", "block", "node", "copies", "vector")
    dealt = dealt.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
    return dealt.mapInArrow(_verifier(width, threshold), "node bigint, texts bigint, docs bigint, near bigint")


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _mark(vector: Column) -> list[Column]:
    return [F.xxhash64(vector).alias("m1"), F.xxhash64(vector, F.lit(0x5EED)).alias("m2")]


def cosine_classes(
    rows: DataFrame, id_col: str, vector_col: str, threshold: float = THRESHOLD, recall: float = RECALL, probes: int = PROBES,
    bucket_nodes: int = BUCKET_NODES, block_nodes: int = BLOCK_NODES,
) -> DataFrame:
    """One row per row: id, n_links, n_text_links, n_copies, component_id, kept.

    n_links counts the other rows whose cosine reaches the threshold, n_text_links the different vectors among them.
    """
    listed = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), _usable(F.col(vector_col)).alias("usable"))
    listed = listed.withColumn("usable", F.coalesce("usable", F.lit(False)))
    distinct = listed.filter("usable").groupBy("vector").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id"))
    nodes = materialize(distinct.select("*", *_mark(F.col("vector"))).withColumn("node", F.monotonically_increasing_id()), "nodes")
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    width = 1 << max(1, ((size.width or 1) - 1).bit_length())
    hashes = choose_hashes(size.n, width, probes)
    tables = choose_tables(width, hashes, threshold, recall, probes)
    signed = nodes.select("node", "vector").mapInArrow(_signer(width, tables, hashes, probes), "node bigint, codes array<bigint>, s1 bigint, s2 bigint")
    signed = materialize(signed, "signed")

    stars = components(candidate_edges(signed, threshold, bucket_nodes))
    grouped = stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    members, tasks = _place(materialize(grouped, "candidates"), signed, block_nodes)
    links = materialize(_verified(nodes, materialize(members, "members"), tasks, width, threshold), "links")

    classes = components(links.select(F.col("node").alias("u"), F.col("near").alias("v")))
    counts = links.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    labelled = (
        nodes.drop("vector")
        .join(counts, "node", "left")
        .join(classes.select(F.col("u").alias("node"), F.col("v").alias("label")), "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    heads = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    info = labelled.join(heads, "label").select(
        "m1", "m2", (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_text_links"),
        F.col("copies").alias("n_copies"), "component_id",
    )
    info = materialize(info, "classes")
    keys = listed.select("id", *[F.when(F.col("usable"), m).alias(name) for m, name in zip(_mark(F.col("vector")), ("m1", "m2"))])
    joined = keys.join(F.broadcast(info) if fits(info) else info, ["m1", "m2"], "left")
    component = F.when(F.col("n_copies").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).cast("bigint").alias("n_text_links"),
        F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cosine_classes(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


QUERIES = {"op11_vector_dedup": op11_vector_dedup}
ORACLE = {
    "op11_vector_dedup": """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS (
  SELECT rid, vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS MATERIALIZED (SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b ON a.rid <> b.rid AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(rid, root) AS (SELECT rid, rid FROM v UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.rid),
c AS (SELECT r.rid, min(h.vec_id) AS component_id FROM r JOIN v h ON h.rid = r.root GROUP BY r.rid),
l AS (SELECT a AS rid, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN c USING (rid) LEFT JOIN l USING (rid)
"""
}
