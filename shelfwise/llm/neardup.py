"""N-gram Jaccard self-join by MinHash banding, verified on full n-gram sets.

1. One pass over the texts gives each document its set of five-word shingles as a fingerprint, and the band
   hashes of its MinHash signature. Bands and rows are chosen for a target recall at the threshold.
2. Documents with equal shingle sets are one node from here on: copies are never paired.
3. Nodes are shuffled by band hash; every bucket contributes a star around its smallest node, so a bucket of m
   nodes makes m - 1 edges. Components of these edges are the candidate groups.
4. Candidate groups are verified exactly: the nodes' full shingle sets meet in tasks of bounded size, where all
   pairs are compared by matrix products. A large group is cut in blocks along a band hash, so that similar
   nodes are near each other, and the pairs of blocks that share a bucket are its tasks. A task sends back one
   row per node: its number of links and a spanning edge, never the pairs.
5. Components of the spanning edges are the classes.

Verification covers more pairs than those that share a band, so the recall of links is above that of banding
alone. The work is linear but for groups of different near copies, whose links must be counted: those take one
product per pair of blocks.

Defined results: words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z; a text of fewer than five
words has one shingle, all its words; texts without words are copies if they are equal; a null text is
alone in its class; repeated rows are copies; the class id is the smallest id of the class that is not null; an
empty table gives no rows; other columns are ignored by `jaccard_classes` and kept by `drop_near_duplicates`
(whose documents may not have columns that start with `_dup_`).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm import textbytes
from shelfwise.llm.graph import components
from shelfwise.llm.ordering import running_total
from shelfwise.session import fits, materialize, spread_out
from shelfwise.sources.tables import table

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
RECALL = 0.9999
MAX_HASHES = 128
# A block of a large candidate group: shingles and nodes it holds at most.
BLOCK_SHINGLES = 500_000
BLOCK_NODES = 1024
COLUMNS = 4096


def choose_bands(threshold: float, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest false candidates, that reach the recall at the threshold."""
    best = None
    for rows in range(1, max_hashes + 1):
        chance = threshold**rows
        bands = 1 if chance >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-chance)) if chance > 1e-12 else max_hashes + 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"no bands reach recall {recall} with {max_hashes} hashes")
    return best


def shingle_sets(found: textbytes.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, first): the distinct shingles of each text, sorted; those of text d are first[d]:first[d + 1]."""
    hashes, n = textbytes.word_hashes(found), np.diff(found.first)
    starts = np.maximum(n - size + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), starts)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(starts) - starts, starts) + found.first[doc]
    shingles = np.empty(len(doc), np.uint64)
    long_ = n[doc] >= size
    if long_.any():
        shingles[long_] = textbytes.ngram_hashes(hashes, size)[place[long_]]
    for length in range(1, size):
        own = n[doc] == length
        if own.any():
            shingles[own] = textbytes.ngram_hashes(hashes, length)[place[own]] + np.uint64(length)
    order = np.lexsort((shingles, doc))
    shingles, doc = shingles[order], doc[order]
    keep = np.ones(len(doc), bool)
    keep[1:] = (shingles[1:] != shingles[:-1]) | (doc[1:] != doc[:-1])
    return shingles[keep], np.searchsorted(doc[keep], np.arange(len(n) + 1))


def _per_text(ufunc, values: np.ndarray, first: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Reduce the values of every text that has any."""
    return ufunc.reduceat(values, first[:-1][filled]) if filled.any() else values[:0]


def signatures(texts: pa.Array, size: int, bands: int, rows: int) -> Iterator[tuple[bytes | None, int, list[int]]]:
    """Per text: fingerprint of its shingle set (null for a null text), number of shingles, band hashes."""
    random = np.random.default_rng(size)
    factors = random.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = random.integers(0, 2**63, bands * rows, dtype=np.uint64)
    mapped, is_null = textbytes.alphanumeric_table(), texts.is_null().to_numpy(zero_copy_only=False)
    for low, high, data, offsets in textbytes.blocks(texts):
        shingles, first = shingle_sets(textbytes.words(data, offsets, mapped), size)
        counts = np.diff(first)
        filled = counts > 0
        with np.errstate(over="ignore"):
            sums = [_per_text(np.add, textbytes.mix(shingles ^ np.uint64(salt)), first, filled) for salt in (0x51, 0xA7)]
            codes = np.zeros((int(filled.sum()), bands), np.uint64)
            for k in range(bands * rows):
                least = _per_text(np.minimum, shingles * factors[k] + shifts[k], first, filled)
                codes[:, k // rows] = textbytes.mix(codes[:, k // rows] + least + np.uint64(k))
        codes, at = codes.view(np.int64), 0
        for d in range(high - low):
            if is_null[low + d]:
                yield None, 0, []
            elif not filled[d]:
                yield hashlib.blake2b(data[offsets[d] : offsets[d + 1]].tobytes(), digest_size=20).digest(), 0, []
            else:
                mark = np.array([sums[0][at], sums[1][at], counts[d]], np.uint64).tobytes()
                yield mark, int(counts[d]), codes[at].tolist()
                at += 1


def sign(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """(id, key, mark, n, bands) of every row; `key` is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(signatures(batch["text"], size, bands, rows))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["key"], pa.array([f[0] for f in found], pa.binary()),
                 pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.list_(pa.int64()))],
                names=["id", "key", "mark", "n", "bands"],
            )

    narrow = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return spread_out(narrow).mapInArrow(run, f"id {kind}, key bigint, mark binary, n int, bands array<bigint>")


def text_key(text_col: str) -> Column:
    return F.xxhash64(text_col)


def candidate_edges(nodes: DataFrame) -> DataFrame:
    """(u, v): each node of a band bucket with the smallest of the bucket; `nodes` has node and bands."""
    coded = nodes.select(F.explode("bands").alias("code"), "node")
    leads = coded.groupBy("code").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m")
    return coded.join(leads, "code").filter("node <> lead").select(F.col("node").alias("u"), F.col("lead").alias("v")).distinct()


def shared_counts(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of sorted sets: all of `left` with all of `right` (or `left` itself)."""
    sets = left if right is None else left + right
    values = np.concatenate(sets)
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    useful = times[column] > 1  # others are in one set only
    numbers, column = np.unique(column[useful], return_inverse=True)
    row = row[useful]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(left) if right is None else len(right)), np.float32)
    for low in range(0, len(numbers), COLUMNS):
        at = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        block = np.zeros((len(sets), min(COLUMNS, len(numbers) - low)), np.float32)
        block[row[at], column[at] - low] = 1
        out += block @ block.T if right is None else block[: len(left)] @ block[len(left) :].T
    return out


def _linked(common: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Which pairs reach the threshold, by whole numbers."""
    num, den = threshold.numerator, threshold.denominator
    return (num + den) * common.astype(np.int64) >= num * (left[:, None] + right[None, :])


def _smallest_reached(adjacent: np.ndarray) -> np.ndarray:
    """Per row of a symmetric matrix: the smallest row of its component."""
    label = np.arange(len(adjacent))
    while True:
        near = np.where(adjacent, label[None, :], len(label)).min(axis=1, initial=len(label))
        now = np.minimum(label, near)
        now = now[now]
        if (now == label).all():
            return label
        label = now


def verify(nodes: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None, threshold: Fraction):
    """Per node: links to different sets, links counted with copies, and a node of its part of the task's links."""
    sizes = np.array([len(s) for s in sets])
    if side is None:
        adjacent = _linked(shared_counts(sets), sizes, sizes, threshold)
        np.fill_diagonal(adjacent, False)
    else:
        a, b = np.flatnonzero(~side), np.flatnonzero(side)
        adjacent = np.zeros((len(sets), len(sets)), bool)
        if len(a) and len(b):
            pairs = _linked(shared_counts([sets[i] for i in a], [sets[i] for i in b]), sizes[a], sizes[b], threshold)
            adjacent[np.ix_(a, b)], adjacent[np.ix_(b, a)] = pairs, pairs.T
    return adjacent.sum(axis=1), adjacent @ copies, nodes[_smallest_reached(adjacent)]


def _verifier(threshold: Fraction):
    """Streams sorted rows (root, low, high, block, node, copies, shingles) and verifies one task after another."""

    def finish(task: tuple, rows: list) -> pa.RecordBatch:
        distinct = {r[1]: r for r in rows}  # a repeated document brings its node twice
        nodes = np.array(sorted(distinct), np.int64)
        rows = [distinct[n] for n in nodes.tolist()]
        side = np.array([r[0] == task[2] for r in rows]) if task[1] != task[2] else None
        copies = np.array([r[2] for r in rows], np.int64)
        texts, docs, near = verify(nodes, copies, [r[3] for r in rows], side, threshold)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes), pa.array(texts.astype(np.int64)), pa.array(docs.astype(np.int64)), pa.array(near)],
            names=["node", "texts", "docs", "near"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows = None, []
        for batch in batches:
            keys = [batch[c].to_numpy() for c in ("root", "low", "high", "block", "node", "copies")]
            sets = batch["shingles"]
            for i in range(batch.num_rows):
                own = tuple(int(k[i]) for k in keys[:3])
                if own != task:
                    if rows:
                        yield finish(task, rows)
                    task, rows = own, []
                rows.append((int(keys[3][i]), int(keys[4][i]), int(keys[5][i]), sets[i].values.to_numpy().copy()))
        if rows:
            yield finish(task, rows)

    return run


def _set_reader(size: int):
    """Rows of candidate documents with their text replaced by its shingle set; a repeated row once per task."""
    mapped = textbytes.alphanumeric_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            new = []
            for node in batch["node"].to_pylist():
                new.append(node not in seen)
                seen.add(node)
            batch = batch.filter(pa.array(new, pa.bool_()))
            for low, high, data, offsets in textbytes.blocks(batch["text"]):
                shingles, first = shingle_sets(textbytes.words(data, offsets, mapped), size)
                sets = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(shingles.view(np.int64)))
                kept = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*(kept[c] for c in _MEMBER), sets], names=[*_MEMBER, "shingles"])

    return run


_MEMBER = ("root", "block", "node", "copies")


def place_members(members: DataFrame, banded: DataFrame, block_shingles: int, block_nodes: int) -> tuple[DataFrame, DataFrame | None]:
    """Candidate nodes with their `block`, and the tasks (root, block, low, high) of blocks of groups that have several."""
    capacity = block_shingles * block_nodes
    sized = members.withColumn("weight", F.col("n") * block_nodes + block_shingles)  # fills a block by shingles or by nodes
    whole = sized.groupBy("root").agg(F.sum("weight").alias("total"))
    sized = sized.join(whole, "root")
    columns = ["node", "root", "copies", "rep_id", "rep_key", "block"]
    small = sized.filter(F.col("total") <= capacity).withColumn("block", F.lit(0)).select(*columns)
    large = materialize(sized.filter(F.col("total") > capacity).join(banded, "node").dropDuplicates(["node"]), "large")
    if large.isEmpty():
        return small, None
    order = [F.col(c).asc() for c in ("root", "near", "node")]
    placed = running_total(large.withColumn("near", F.col("bands")[0]), order, "weight")
    starts = placed.groupBy("root").agg(F.min("before").alias("start"))
    placed = placed.join(starts, "root").withColumn("block", F.floor((F.col("before") - F.col("start")) / capacity).cast("int"))
    placed = materialize(placed.select("node", "root", "copies", "rep_id", "rep_key", "block", "bands"), "placed")
    held = placed.select("root", "block", F.explode("bands").alias("code")).distinct()
    other = held.select("root", F.col("block").alias("high"), "code")
    shared = held.withColumnRenamed("block", "low").join(other, ["root", "code"]).filter("low <= high").select("root", "low", "high").distinct()
    tasks = shared.withColumn("block", F.explode(F.array_distinct(F.array("low", "high"))))
    return small.unionByName(placed.select(*columns)), materialize(tasks, "tasks")


def verified_links(docs: DataFrame, members: DataFrame, tasks: DataFrame | None, id_col: str, text_col: str, size: int,
                   threshold: Fraction) -> DataFrame:
    """(node, texts, docs, near) per task; `members` are the candidate nodes with the row that stands for each."""
    named = members.select("rep_id", "rep_key", *_MEMBER)
    named = F.broadcast(named) if fits(members) else named
    texts = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    read = texts.join(named, F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("key") == F.col("rep_key")))
    schema = "root bigint, block int, node bigint, copies bigint, shingles array<bigint>"
    sets = read.select(*_MEMBER, "text").mapInArrow(_set_reader(size), schema)
    if tasks is None:
        dealt = sets.withColumns({"low": F.lit(0), "high": F.lit(0)})
    else:  # a group of one block has no entry
        dealt = sets.join(F.broadcast(tasks) if fits(tasks) else tasks, ["root", "block"], "left").na.fill(0, ["low", "high"])
    dealt = dealt.select("root", "low", "high", "block", "node", "copies", "shingles")
    dealt = dealt.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
    return dealt.mapInArrow(_verifier(threshold), "node bigint, texts bigint, docs bigint, near bigint")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: Fraction = THRESHOLD,
                    recall: float = RECALL, block_shingles: int = BLOCK_SHINGLES, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """One row per document: id, key (hash of its text), class_id, stays, n_links, n_text_links, n_copies.

    n_links counts the other documents at the threshold or above, copies included; n_text_links only different
    shingle sets; n_copies the documents with the same set. `stays` marks one row value of each class.
    """
    bands, rows = choose_bands(float(threshold), recall)
    signed = materialize(sign(docs, id_col, text_col, size, bands, rows), "signatures")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    nodes = signed.filter("mark IS NOT NULL").groupBy("mark").agg(
        F.count(F.lit(1)).alias("copies"), F.min(order).alias("rep"), F.max("n").cast("bigint").alias("n")
    )
    nodes = nodes.select("mark", "copies", "n", F.col("rep.id").alias("rep_id"), F.col("rep.key").alias("rep_key"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    own = nodes.select(F.col("mark").alias("_mark"), "rep_id", "rep_key", "node")
    same = (F.col("mark") == F.col("_mark")) & F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("key") == F.col("rep_key"))
    banded = signed.select("id", "key", "mark", "bands").join(own, same).select("node", "bands")  # a row per repeat of a node's row
    edges = candidate_edges(banded)

    stars = components(edges)
    grouped = stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    members = materialize(nodes.join(grouped, "node"), "candidates")
    members, tasks = place_members(members, banded, block_shingles, block_nodes)
    members = materialize(members, "members")
    links = materialize(verified_links(docs, members, tasks, id_col, text_col, size, threshold), "links")

    classes = components(links.select(F.col("node").alias("u"), F.col("near").alias("v")))
    counts = links.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    labelled = (
        nodes.join(counts, "node", "left")
        .join(classes.select(F.col("u").alias("node"), F.col("v").alias("label")), "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    first = F.min(F.struct(F.col("rep_id").isNull().alias("none"), "rep_id", "rep_key"))
    heads = labelled.groupBy("label").agg(first.alias("head"))
    info = labelled.join(heads, "label").select(
        F.col("mark").alias("_mark"), "copies", F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("docs", F.lit(0)).alias("docs"),
        F.col("head.rep_id").alias("head_id"), F.col("head.rep_key").alias("head_key"),
    )
    info = materialize(info, "classes")
    joined = signed.select("id", "key", "mark").join(info, F.col("mark") == F.col("_mark"), "left")
    alone = F.col("mark").isNull()
    return joined.select(
        "id",
        "key",
        F.when(alone, F.col("id")).otherwise(F.col("head_id")).alias("class_id"),
        (alone | (F.col("id").eqNullSafe(F.col("head_id")) & (F.col("key") == F.col("head_key")))).alias("stays"),
        F.when(alone, F.lit(0)).otherwise(F.col("docs") + F.col("copies") - 1).cast("bigint").alias("n_links"),
        F.when(alone, F.lit(0)).otherwise(F.col("texts")).cast("bigint").alias("n_text_links"),
        F.when(alone, F.lit(1)).otherwise(F.col("copies")).cast("bigint").alias("n_copies"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents with one row of each class, all columns as they are.

    Only rows that go, or that repeat the one that stays, are looked up; the rest pass where they are read.
    """
    classes = jaccard_classes(docs, id_col, text_col, **settings)
    marks = classes.groupBy(F.col("id").alias("_dup_id"), F.col("key").alias("_dup_key")).agg(
        F.max("stays").alias("_dup_stays"), F.count(F.lit(1)).alias("_dup_n"), F.max("n_copies").alias("_dup_copies")
    )
    # Null texts have no copies, so each of their rows stays.
    marks = materialize(marks.filter("NOT _dup_stays OR (_dup_n > 1 AND _dup_copies > 1)").select("_dup_id", "_dup_key", "_dup_stays"), "marks")
    lookup = F.broadcast(marks) if fits(marks) else marks
    matched = docs[id_col].eqNullSafe(F.col("_dup_id")) & (text_key(text_col) == F.col("_dup_key"))
    joined = docs.join(lookup, matched, "left")
    kept = joined.filter("_dup_stays IS NULL").select(*[docs[c] for c in docs.columns])
    if marks.filter("_dup_stays").isEmpty():
        return kept
    one = Window.partitionBy("_dup_id", "_dup_key").orderBy(F.xxhash64(*[docs[c] for c in docs.columns]))
    repeated = joined.filter("_dup_stays").withColumn("_dup_place", F.row_number().over(one)).filter("_dup_place = 1")
    return kept.unionByName(repeated.select(*[docs[c] for c in docs.columns]))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", "n_text_links", "n_copies")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
QUERIES = {"op2_jaccard_join": op2_jaccard_join}
ORACLE = {
    "op2_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, text, {_WORDS} AS w FROM documents),
g AS (
  SELECT rid, doc_id, text, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))) END AS s
  FROM d),
k AS (
  SELECT rid, doc_id, s, CASE WHEN text IS NULL THEN 'null ' || rid WHEN len(s) = 0 THEN 'text ' || text
    ELSE 'set ' || array_to_string(s, '|') END AS mark FROM g),
n AS (SELECT mark, min(doc_id) AS rep, count(*) AS copies, any_value(s) AS s, row_number() OVER (ORDER BY mark) AS node FROM k GROUP BY mark),
u AS (SELECT node, len(s) AS size, unnest(s) AS gram FROM n),
p AS (
  SELECT a.node AS a, b.node AS b FROM u a JOIN u b ON a.gram = b.gram AND a.node <> b.node
  GROUP BY a.node, b.node, a.size, b.size HAVING 9 * count(*) >= 4 * (a.size + b.size)),
r(node, root) AS (SELECT node, node FROM n UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.node),
c AS (SELECT r.node, min(h.rep) AS class_id FROM r JOIN n h ON h.node = r.root GROUP BY r.node),
l AS (SELECT p.a AS node, count(*) AS texts, sum(n.copies) AS docs FROM p JOIN n ON n.node = p.b GROUP BY p.a)
SELECT k.doc_id, c.class_id, (coalesce(l.docs, 0) + n.copies - 1)::BIGINT AS n_links,
       coalesce(l.texts, 0)::BIGINT AS n_text_links, n.copies::BIGINT AS n_copies
FROM k JOIN n USING (mark) JOIN c ON c.node = n.node LEFT JOIN l ON l.node = n.node
"""
}
