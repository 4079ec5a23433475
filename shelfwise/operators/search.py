"""Top-k retrieval: exact and approximate vector search, BM25, fusion, filters and the index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import text as ft
from shelfwise.functions.keywords import KeywordK, QuestionTerms, term_counts
from shelfwise.functions.topk import id_array
from shelfwise.functions.vectors import NearestK, matrix
from shelfwise.operators.parts import search_parts
from shelfwise.session import BROADCAST_ROWS, fits, scratch_dir, spread_join
from shelfwise.sources.files import overwrite

# Question matrices up to this size are sent to every task; larger sets take the block join.
QUESTION_BYTES = 64 * 1024 * 1024
QUESTION_BLOCK = 4096
CORPUS_BLOCK = 65536
# Blocks of a corpus that goes to the tasks in parts: a part is in every worker's memory.
PART_BLOCKS = 4
# Cells of an index: their centres go to every task.
MAX_CELLS = 65536
# Pairs of a question and a cell looked at in one step; each becomes a row with the question's vector.
CELLS_AT_ONCE = 65_536
# Question terms that go to the tasks of one keyword scan.
SCAN_TERMS = BROADCAST_ROWS
# Rows the centres are fitted on.
TRAIN_ROWS = 65_536


def rank_top(scored: DataFrame, k: int, by: str = "question_id", tie: tuple[str, ...] = ("id",)) -> DataFrame:
    """Best k rows per question; Spark prunes to k per task before the shuffle."""
    order = W.partitionBy(by).orderBy(F.desc("score"), *tie)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    return pa.string() if df.schema[column].dataType.simpleString() == "string" else pa.int64()


def _grouped(values: np.ndarray) -> dict:
    """Positions of each value, from one sort."""
    distinct, place = np.unique(values, return_inverse=True)
    order = np.argsort(place, kind="stable")
    starts = np.searchsorted(place[order], np.arange(len(distinct) + 1))
    return {value: order[low:high] for value, low, high in zip(distinct.tolist(), starts[:-1], starts[1:])}


def one_part(questions: DataFrame, corpus: DataFrame) -> bool:
    """Whether questions are more than a block and the corpus is at most a part: it then goes to the questions."""
    return fits(corpus.select("id"), PART_BLOCKS * CORPUS_BLOCK) and not fits(questions.select("id"), QUESTION_BLOCK)


def knn(
    questions: DataFrame,
    corpus: DataFrame,
    k: int = config.TOP_K,
    skip_same: bool = False,
    question_bytes: int = QUESTION_BYTES,
    dim: int = config.EMBEDDING_DIM,
) -> DataFrame:
    """Exact cosine top-k: (question_id, rank, id, score).

    Both sides have `id`, `vector` and optionally `scope`; a question only sees rows of its scope
    (a question may be listed once per scope it may see). The corpus is read once and never
    shuffled while the question matrix fits `question_bytes`. Beyond that, and where the corpus is no more than one part,
    it goes to blocks of questions in parts; with scopes both sides are cut into blocks, and every pair of blocks
    is one bounded task.
    """
    scoped = "scope" in questions.columns
    if not scoped:
        questions, corpus = questions.withColumn("scope", F.lit(0)), corpus.withColumn("scope", F.lit(0))
    questions, corpus = questions.select("id", "vector", "scope"), corpus.select("id", "vector", "scope")
    id_type, question_type = _arrow_type(corpus, "id"), _arrow_type(questions, "id")
    schema = f"question_id {questions.schema['id'].dataType.simpleString()}, id {corpus.schema['id'].dataType.simpleString()}, score double"

    def holder(table: pa.Table) -> NearestK:
        return NearestK(matrix(table["vector"]), id_array(table["id"]), _grouped(id_array(table["scope"])), k, skip_same)

    def feed(best: NearestK, rows: pa.RecordBatch | pa.Table) -> None:
        ids, vectors = id_array(rows["id"]), matrix(rows["vector"])
        for scope, at in _grouped(id_array(rows["scope"])).items():
            best.add(ids[at], vectors[at], scope)

    few = fits(questions, question_bytes // (8 * dim))
    if few and (scoped or not one_part(questions, corpus)):
        shared = questions.sparkSession.sparkContext.broadcast(questions.toArrow())

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = holder(shared.value)
            for batch in batches:
                if batch.num_rows:
                    feed(best, batch)
            yield best.batch(id_type, question_type)

        return rank_top(corpus.mapInArrow(scan, schema), k)

    if not scoped:
        found = search_parts(questions, corpus, k, skip_same, PART_BLOCKS * CORPUS_BLOCK, QUESTION_BLOCK)
        return rank_top(found.drop("scored"), k)

    # Blocks are cut per scope, so no row meets a block of a foreign scope.
    sizes = questions.groupBy("scope").agg(F.count(F.lit(1)).alias("q")).join(
        corpus.groupBy("scope").agg(F.count(F.lit(1)).alias("c")), "scope"
    ).select("scope", F.ceil(F.col("q") / QUESTION_BLOCK).alias("qn"), F.ceil(F.col("c") / CORPUS_BLOCK).alias("cn"))
    sizes = F.broadcast(sizes) if fits(sizes) else sizes

    def cut(df: DataFrame, own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        return df.join(sizes, "scope").select(
            *[F.col(c).alias(c) for c in ("id", "vector", "scope")],  # new names on each side: both may be one table
            F.pmod(F.xxhash64("id"), F.col(own_count)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other_count) - 1)).alias(other),
        )

    asked, held = cut(questions, "qb", "qn", "cb", "cn"), cut(corpus, "cb", "cn", "qb", "qn")

    def pair(asked_rows: pa.Table, held_rows: pa.Table) -> pa.Table:
        best = holder(asked_rows)
        if held_rows.num_rows and asked_rows.num_rows:
            feed(best, held_rows)
        return pa.Table.from_batches([best.batch(id_type, question_type)])

    keys = ["scope", "qb", "cb"]
    scored = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(pair, schema)
    return rank_top(scored, k)


def knn_filtered(questions: DataFrame, corpus: DataFrame, filters: dict[str, object], **options) -> DataFrame:
    """Equality filters on metadata, applied before ranking."""
    for column, value in filters.items():
        corpus = corpus.filter(F.col(column).eqNullSafe(F.lit(value)))
    return knn(questions, corpus, **options)


def knn_for_tenant(questions: DataFrame, corpus: DataFrame, tenant: str | None, **options) -> DataFrame:
    """Search inside the asking tenant only; a call without a tenant column is refused."""
    if not tenant or tenant not in questions.columns or tenant not in corpus.columns:
        raise PermissionError("a tenant column is mandatory on both sides")
    with_scope = [
        df.filter(F.col(tenant).isNotNull()).withColumn("scope", F.col(tenant)) for df in (questions, corpus)
    ]
    return knn(*with_scope, **options)


def rows_for_user(rows: DataFrame, memberships: DataFrame, user: str, region: str = "region") -> DataFrame:
    """Row filter of one caller, to be applied before any ranking.

    Admins see every row; others the rows whose `region_<lower(region)>` group they are in, so a
    row without a region is invisible to them. `memberships` is (user, group).
    """
    mine = memberships.filter(F.col("user") == user)
    is_admin = mine.filter("group = 'global_admins'").agg(F.count(F.lit(1)) > 0).scalar()
    groups = mine.agg(F.collect_set("group")).scalar()
    member = F.array_contains(groups, F.concat(F.lit("region_"), F.lower(region)))
    return rows.filter(is_admin | F.coalesce(member, F.lit(False)))


def rows_for_users(rows: DataFrame, memberships: DataFrame, region: str = "region") -> DataFrame:
    """The row filter of every user at once, in one scan: the rows with each `user` who may see them."""
    users = memberships.groupBy(F.col("group").alias("_group")).agg(F.collect_set("user").alias("_users"))
    admins = memberships.filter("group = 'global_admins'").agg(F.collect_set("user")).scalar()
    listed = rows.join(F.broadcast(users) if fits(users) else users, F.concat(F.lit("region_"), F.lower(region)) == F.col("_group"), "left")
    seeing = F.array_union(F.coalesce("_users", F.array().cast("array<string>")), admins)
    return listed.withColumn("user", F.explode(seeing)).drop("_group", "_users")


def policy_violations(hits: DataFrame, rows: DataFrame, memberships: DataFrame, key: str) -> DataFrame:
    """Hits (user, key) whose user may not see the row; a hit on a row that does not exist is one.

    Hits of one user or on one row may be many: both sides they meet are broadcast after a size check, else spread.
    """
    listed = rows.select(key, "region")
    shown = spread_join(hits, listed, [key], ["user"], "left", small_fits=fits(listed))
    groups = memberships.groupBy("user").agg(F.collect_set("group").alias("groups"))
    allowed = F.array_contains("groups", "global_admins") | F.array_contains(
        "groups", F.concat(F.lit("region_"), F.lower("region"))
    )
    granted = spread_join(shown, groups, ["user"], [key], "left", small_fits=fits(groups))
    return granted.filter(~F.coalesce(allowed, F.lit(False))).drop("groups")


# ---------------------------------------------------------------- approximate search


def assign_cells(corpus: DataFrame, cells: int, seed: int = 42, max_iter: int = 10) -> tuple[DataFrame, np.ndarray]:
    """Coarse clustering of unit vectors: corpus with its cell, and the cell centres.

    Centres are fitted on the TRAIN_ROWS rows with the smallest id hashes; every row gets a cell.
    """
    featured = corpus.withColumn("features", array_to_vector(F.col("vector").cast("array<double>")))
    sample = featured.orderBy(F.xxhash64("id")).limit(TRAIN_ROWS)
    model = KMeans(k=cells, seed=seed, maxIter=max_iter, predictionCol="cell").fit(sample)
    return model.transform(featured).drop("features"), np.array(model.clusterCenters())


def _plain(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def cell_lists(vectors: np.ndarray, centres: np.ndarray, probes: int) -> pa.Array:
    """The nearest cells of each row as a list, nearest first."""
    far, n = np.square(centres).sum(axis=1)[None, :], min(probes, len(centres))
    near = np.empty((len(vectors), n), np.int64)
    step = max(1, CELLS_AT_ONCE // len(centres))
    for begin in range(0, len(vectors), step):
        apart = far - 2 * vectors[begin : begin + step] @ centres.T
        near[begin : begin + step] = np.argsort(apart, axis=1, kind="stable")[:, :n]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1) * n, pa.int32()), pa.array(near.ravel()))


def nearest_cells(questions: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """One row per question and probed cell."""

    def closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A slice repeats a row once per probed cell, with its vector.
            step = max(1, CELLS_AT_ONCE // len(centres))
            for begin in range(0, batch.num_rows, step):
                part = batch.slice(begin, step)
                near = cell_lists(_plain(part["vector"]), centres, probes).flatten().cast(pa.int32())
                rows = part.take(pa.array(np.repeat(np.arange(part.num_rows), len(near) // part.num_rows)))
                yield pa.RecordBatch.from_arrays([*rows.columns, near], names=[*part.schema.names, "scope"])

    columns = ", ".join(f"`{name}` {kind}" for name, kind in questions.dtypes)
    return questions.mapInArrow(closest, f"{columns}, scope int")


def build_ivf(corpus: DataFrame, path: str, cells: int = 16) -> np.ndarray:
    """Write the corpus partitioned by cell, hot cells split over files; the cell centres come back."""
    celled, centres = assign_cells(corpus, cells)
    overwrite(celled.select("id", "vector", F.col("cell").alias("scope")), path, "scope")
    return centres


def search_ivf(
    questions: DataFrame, path: str, centres: np.ndarray, probes: int, k: int = config.TOP_K, skip_same: bool = False,
    question_bytes: int = QUESTION_BYTES, dim: int = config.EMBEDDING_DIM,
) -> DataFrame:
    """Search the `probes` nearest cells of each question, scored exactly; other cells are not read.

    A question is listed once per probed cell while these lists fit `question_bytes`; beyond, blocks of questions meet
    parts of the corpus, and the cells of a question are found where its block is.
    """
    questions, stored = questions.select("id", "vector"), questions.sparkSession.read.parquet(path)
    listed = min(probes, len(centres))
    if fits(questions, question_bytes // (8 * dim * listed)):
        asked = nearest_cells(questions, centres, probes)
        probed = F.broadcast(asked.select("scope").distinct())  # at most one row per cell
        return knn(asked, stored.join(probed, "scope", "left_semi"), k, skip_same, question_bytes, dim)

    near = F.arrow_udf(lambda vectors: cell_lists(_plain(vectors), centres, probes), "array<bigint>")
    probed = F.broadcast(questions.select(F.explode(near("vector")).alias("scope")).distinct())
    index = stored.join(probed, "scope", "left_semi")
    index = index.select("id", "vector", F.array(F.col("scope").cast("bigint")).alias("scopes"))
    block = min(QUESTION_BLOCK, max(1, QUESTION_BYTES // (8 * (dim + listed))))

    def ask(vectors: pa.Array) -> tuple[np.ndarray, pa.Array]:
        return matrix(vectors), cell_lists(_plain(vectors), centres, probes)

    return rank_top(search_parts(questions, index, k, skip_same, PART_BLOCKS * CORPUS_BLOCK, block, ask).drop("scored"), k)


def ivf_size(rows: int) -> tuple[int, int]:
    """(cells, probes) for a corpus: about a cell per square root of its rows, and enough probes for recall 0.9 on vectors
    without much structure; well separated ones need far fewer."""
    cells = max(1, min(MAX_CELLS, round(math.sqrt(rows))))
    return cells, math.ceil(0.6 * cells)


def knn_ivf(questions: DataFrame, corpus: DataFrame, cells: int | None = None, probes: int | None = None, **options) -> DataFrame:
    """Approximate search over cells sized by the corpus; with as many probes as cells it is exact."""
    sized = ivf_size(corpus.count()) if cells is None or probes is None else (cells, probes)
    cells, probes = cells or sized[0], probes or sized[1]
    path = scratch_dir(corpus.sparkSession, "cells")
    return search_ivf(questions, path, build_ivf(corpus, path, cells), probes, **options)


def recall(exact: DataFrame, found: DataFrame) -> DataFrame:
    """Share of the exact hits an approximate search found, per question."""
    both = exact.select("question_id", "id").join(
        found.select("question_id", "id", F.lit(1).alias("hit")), ["question_id", "id"], "left"
    )
    return both.groupBy("question_id").agg(F.round(F.count("hit") / F.count(F.lit(1)), 6).alias("recall"))


# ---------------------------------------------------------------- keyword search


def bm25(
    questions: DataFrame,
    corpus: DataFrame,
    k: int = config.TOP_K,
    k1: float = config.BM25_K1,
    b: float = config.BM25_B,
    question_terms: int = BROADCAST_ROWS,
    best_per_id: bool = False,
) -> DataFrame:
    """BM25 top-k: (question_id, rank, id, score) for tables with `id` and `text`.

    Question terms go to every task, which scores its documents and emits k rows per question; the
    corpus is scanned twice (statistics, scores) and never shuffled, so a frequent term is no hot
    group. Questions with more than `question_terms` terms together are scored in blocks of at most
    so many. The blocks of one scan share what it reads and counts; they have SCAN_TERMS terms
    together, and more questions take further scans. The result does not depend on their number.

    Every row is a document, also one with NULL text, which is empty. Rows of one id are several
    documents; with `best_per_id` such an id is one candidate, with the score of its best row.
    """
    asked = questions.select(F.col("id").alias("question_id"), F.explode(F.array_distinct(ft.tokens(F.col("text")))).alias("term"))
    scans = 1 if fits(asked, SCAN_TERMS) else math.ceil(asked.count() / SCAN_TERMS)
    found = None
    for scan in range(scans):
        part = asked if scans == 1 else asked.filter(F.pmod(F.xxhash64("question_id"), F.lit(scans)) == scan)
        scored = _bm25_scan(part, corpus, k, k1, b, question_terms, best_per_id)
        found = scored if found is None else found.unionByName(scored)
    if best_per_id:
        found = found.groupBy("question_id", "id").agg(F.max("score").alias("score"))
    return rank_top(found, k)


def _bm25_scan(asked: DataFrame, corpus: DataFrame, k: int, k1: float, b: float, block_terms: int, best_per_id: bool) -> DataFrame:
    listed = corpus.select("id", F.coalesce(ft.tokens(F.col("text")), F.array().cast("array<string>")).alias("tokens"))
    known = asked.toArrow()
    vocabulary = pa.array(sorted(set(known["term"].to_pylist())), pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, documents, words = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            for _, _, _, code, _, sizes in term_counts(batch["tokens"], vocabulary, max(1, batch.num_rows)):
                frequency += np.bincount(code, minlength=len(vocabulary))
                documents, words = documents + len(sizes), words + int(sizes.sum())
        code = np.append(np.flatnonzero(frequency), [-1, -2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(code, pa.int32()), pa.array(np.append(frequency[code[:-2]], [documents, words]), pa.int64())],
            names=["code", "n"],
        )

    # One row per asked term at most comes back: the size check bounds it.
    totals = dict(
        map(tuple, listed.select("tokens").mapInArrow(count, "code int, n bigint").groupBy("code").agg(F.sum("n")).collect())
    )
    frequency = np.array([totals.get(i, 0) for i in range(len(vocabulary))], dtype=np.float64)
    documents = totals.get(-1, 0)
    terms = QuestionTerms.build(known, vocabulary, frequency, documents, totals.get(-2, 0) / max(documents, 1), k1, b, block_terms)
    shared = asked.sparkSession.sparkContext.broadcast(terms)
    id_type, question_type = _arrow_type(corpus, "id"), _arrow_type(asked, "question_id")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = KeywordK(shared.value, k, best_per_id)
        for batch in batches:
            best.add(batch)
        yield best.batch(id_type, question_type)

    names = (asked.schema["question_id"].dataType.simpleString(), corpus.schema["id"].dataType.simpleString())
    return listed.mapInArrow(score, f"question_id {names[0]}, id {names[1]}, score double")


def fuse(*ranked: DataFrame, k: int = config.TOP_K, constant: int = config.RRF_CONSTANT) -> DataFrame:
    """Reciprocal-rank fusion of ranked lists; a list that misses a row adds nothing."""
    lists = [r.select("question_id", "id", (F.lit(1.0) / (F.lit(constant) + F.col("rank"))).alias("part")) for r in ranked]
    both = lists[0]
    for other in lists[1:]:
        both = both.unionByName(other)
    return rank_top(both.groupBy("question_id", "id").agg(F.round(F.sum("part"), 6).alias("score")), k)


def hybrid(
    questions: DataFrame, corpus: DataFrame, question_vectors: DataFrame, corpus_vectors: DataFrame,
    k: int = config.TOP_K, depth: int = config.HYBRID_DEPTH,
) -> DataFrame:
    """Keyword and vector rankings fused by reciprocal rank.

    Each list is searched to `depth`; a row below that in a list gets nothing from it, so a greater
    depth comes closer to the fusion of complete lists, and `depth` = corpus size equals it.
    """
    by_word = bm25(questions, corpus, depth)
    by_vector = knn(question_vectors, corpus_vectors, depth)
    return fuse(by_word, by_vector, k=k)


def search_parents(questions: DataFrame, children: DataFrame, k: int = config.TOP_K, **options) -> DataFrame:
    """Each enclosing parent by its best child: `children` has parent_id and text. All children count."""
    return bm25(questions, children.select(F.col("parent_id").alias("id"), "text"), k, best_per_id=True, **options)


# ---------------------------------------------------------------- results


def attach_text(hits: DataFrame, corpus: DataFrame, key: str, text: str, source: str, few: bool = False) -> DataFrame:
    """(question_id, rank, text, source, score): ranking ran on keys, text joins the hits last.

    `few` says the question table passed a size check, so the hits are broadcast and the corpus
    text is not shuffled.
    """
    shown = corpus.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(source).alias("source"))
    return shown.join(F.broadcast(hits) if few else hits, "id").select("question_id", "rank", "text", "source", "score")


def format_context(hits: DataFrame) -> DataFrame:
    """One context string per question, hits in rank order, numbered from one."""
    block = F.format_string(
        "\n--- Document %d ---\nSource: %s\nContent: %s\n", F.col("rank"), F.col("source"), F.col("text")
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", block.alias("block"), "source")))
    return hits.groupBy("question_id").agg(ordered.alias("h")).select(
        "question_id",
        F.array_join(F.transform("h", lambda x: x["block"]), "").alias("context"),
        F.array_distinct(F.transform("h", lambda x: x["source"])).alias("citations"),
    )


def order_for_context(hits: DataFrame) -> DataFrame:
    """Position that puts the best hits first and last: odd ranks rising, then even ranks falling."""
    last = F.max("rank").over(W.partitionBy("question_id"))
    odd_total = F.floor((last + 1) / 2)
    position = F.when(F.col("rank") % 2 == 1, (F.col("rank") + 1) / 2).otherwise(
        odd_total + F.floor(last / 2) - F.col("rank") / 2 + 1
    )
    return hits.withColumn("position", position.cast("int"))
