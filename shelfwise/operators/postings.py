"""A stored keyword index with block-max pruning.

Documents are numbered in blocks of `BLOCK_DOCS` as they are read. The index has an entry per term and block: how many
documents of the block hold the term, the highest weight it has in one of them, and the weights. The entries a term has
in the blocks of one Arrow batch are stored as one row, so that little more than the weights is shuffled and written. A
frequent term has a row per batch, so it is spread; rows lie in folders by a hash of the term, so a search reads the
folders of its terms and, for the bounds, only the narrow columns. Nothing reads the documents again.

A search adds up, per question and block, the highest weights of the question's terms: no document of the block
scores higher. The blocks with the highest bounds are scored first; the k-th score they give a question is the
threshold below which its other blocks are left out, unread. Results are those of a full scan.

An index belongs to one version of its documents (`Index.version`): it is written once, beside others, and a
finished one is found again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import text as ft
from shelfwise.operators.search import rank_top
from shelfwise.session import fits, materialize, spread_out
from shelfwise.sources.files import overwrite

# Documents per block; a power of two.
BLOCK_DOCS = 64
TERM_FOLDERS = 64
# Blocks of each question that set its threshold.
SEED_BLOCKS = 2
# Questions that may be listed beside each block.
QUESTIONS_LISTED = 4096
# More than the rounding of sums and scores.
SLACK = 2e-6


@dataclass(frozen=True)
class Index:
    spark: SparkSession
    path: str
    version: str

    @property
    def folder(self) -> str:
        return f"{self.path}/version={self.version}"

    def exists(self) -> bool:
        """The figures are written last: an index without them was not finished."""
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/figures/_SUCCESS")
        return done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done)

    def _figures(self):
        return self.spark.read.parquet(f"{self.folder}/figures").first()

    def stored(self, terms: DataFrame | None = None) -> DataFrame:
        """The rows of all or the given terms; the schema is given, as an index of no words has no file."""
        rows = self.spark.read.schema(f"{_row(self._figures().kind)}, folder int").parquet(f"{self.folder}/terms")
        return rows if terms is None else rows.join(F.broadcast(terms) if fits(terms) else terms, "term", "left_semi")

    def tops(self, stored: DataFrame) -> DataFrame:
        """Term, block, n and top of stored rows; the weights are not read."""
        return stored.select("term", F.inline(F.arrays_zip(F.col("blocks").alias("block"), F.col("ns").alias("n"), F.col("tops").alias("top"))))

    def terms(self, stored: DataFrame | None = None) -> DataFrame:
        """One row per term and block, of all or of the given stored rows."""

        def entry(b: Column) -> Column:
            held = {c: F.slice(c, b["firsts"] + 1, b["ns"]) for c in ("slots", "ids", "weights")}
            named = [b["blocks"].alias("block"), b["ns"].alias("n"), b["tops"].alias("top"), held["slots"].cast("array<int>").alias("slots")]
            return F.struct(*named, held["ids"].alias("ids"), held["weights"].alias("weights"))

        rows = self.stored() if stored is None else stored
        return rows.select("term", "folder", F.inline(F.transform(F.arrays_zip("blocks", "ns", "tops", "firsts"), entry)))

    def documents(self) -> int:
        return self._figures().documents


def content_version(corpus: DataFrame) -> str:
    """A name for what a table of `id` and `text` holds, whatever the order of its rows."""
    row = F.xxhash64("id", "text", F.col("text").isNull()).cast("decimal(38,0)")
    seen = corpus.agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("sum"), F.bit_xor(F.xxhash64("text", "id")).alias("mix")).first()
    return f"{seen.n}-{int(seen.sum or 0) % 2**64:016x}{(seen.mix or 0) % 2**64:016x}"


def _row(kind: str) -> str:
    narrow = "term string, blocks array<bigint>, ns array<int>, tops array<double>"
    return f"{narrow}, firsts array<int>, slots array<tinyint>, ids array<{kind}>, weights array<double>"


def _folder(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(TERM_FOLDERS)).cast("int")


def _indexer(id_type: pa.DataType, mean_size: float, k1: float, b: float):
    """Rows (block, slot, id, tokens) in order to rows of the index: a term's entries in the whole blocks at hand are one."""

    def rows_of(part: pa.Table) -> pa.RecordBatch:
        lists = part["tokens"].combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        names, codes = coded.dictionary, coded.indices.to_numpy()
        doc = np.repeat(np.arange(len(sizes)), sizes)
        pairs, count = np.unique(codes.astype(np.int64) * len(sizes) + doc, return_counts=True)
        term, doc = pairs // len(sizes), pairs % len(sizes)
        weight = count * (k1 + 1) / (count + k1 * (1 - b + b * sizes[doc] / mean_size))
        block, slot = part["block"].to_numpy()[doc], part["slot"].to_numpy()[doc].astype(np.int8)
        entry = _firsts(term, block)  # the postings a block's entry begins with
        row = _firsts(term[entry])  # the entries a row begins with
        ends, postings = np.append(row, len(entry)).astype(np.int32), np.append(entry, len(term)).astype(np.int32)
        per_row = postings[ends]
        top = np.maximum.reduceat(weight, entry) if len(entry) else weight
        first = postings[:-1] - np.repeat(per_row[:-1], np.diff(ends))
        ids = part["id"].combine_chunks().take(pa.array(doc))
        columns = [
            names.take(pa.array(term[entry[row]])),
            *(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)) for values in (block[entry], np.diff(postings), top, first)),
            *(pa.ListArray.from_arrays(pa.array(per_row), values) for values in (pa.array(slot), ids, pa.array(weight))),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["term", "blocks", "ns", "tops", "firsts", "slots", "ids", "weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, rows]) if held is not None else rows
            cuts = np.flatnonzero(np.diff(held["block"].to_numpy())) + 1
            if len(cuts):
                yield rows_of(held.slice(0, int(cuts[-1])))
                held = held.slice(int(cuts[-1]))
        if held is not None and held.num_rows:
            yield rows_of(held)

    return run


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Positions at which any of the columns, of one length, changes."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    changes = np.any([column[1:] != column[:-1] for column in columns], axis=0)
    return np.flatnonzero(np.append(True, changes))


def write_index(corpus: DataFrame, path: str, version: str | None = None, k1: float = config.BM25_K1, b: float = config.BM25_B) -> Index:
    """Index a table of `id` and `text`; an index of this version that is there already is not written again.

    Every row is a document, also one with NULL text, which is empty.
    """
    index = Index(corpus.sparkSession, path, version or content_version(corpus))
    if index.exists():
        return index
    tokens = F.coalesce(ft.tokens(F.col("text")), F.array().cast("array<string>"))
    listed = materialize(spread_out(corpus).select("id", tokens.alias("tokens"), F.monotonically_increasing_id().alias("place")), "tokens")
    kind = corpus.schema["id"].dataType.simpleString()
    figures = listed.agg(
        F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.size("tokens")), F.lit(0)).alias("words"), F.lit(kind).alias("kind")
    )
    seen = figures.first()
    bits = BLOCK_DOCS.bit_length() - 1
    # Rows lie in order of their places in each file. A block that a scan splits between two tasks has two rows per term: its bound is higher, no more.
    placed = listed.select(F.shiftright("place", bits).alias("block"), F.col("place").bitwiseAND(BLOCK_DOCS - 1).cast("int").alias("slot"), "id", "tokens")
    id_type = pa.string() if kind == "string" else pa.int64()
    rows = placed.mapInArrow(_indexer(id_type, max(seen.words / max(seen.documents, 1), 1e-9), k1, b), _row(kind))
    overwrite(rows.withColumn("folder", _folder(F.col("term"))), f"{index.folder}/terms", "folder")
    figures.write.mode("overwrite").parquet(f"{index.folder}/figures")
    return index


def _scored(pairs: DataFrame, wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """(question_id, block, slot, id, score) of all documents of the given blocks that hold a term of the question.

    Unless the wanted entries are few, rows are dealt by block once, and the scores of a block are added up where its rows are.
    """
    few = fits(wanted)
    needed = pairs.join(F.broadcast(wanted) if few else wanted, "question_id")
    needed = needed.select("question_id", "block", "term", "idf")
    if fits(needed):
        held = rows.join(F.broadcast(needed), ["term", "block"])
    elif few and wanted.select("question_id").distinct().count() <= QUESTIONS_LISTED:
        asking = pairs.groupBy("block").agg(F.collect_set("question_id").alias("asking"))
        dealt = rows.join(asking.hint("shuffle_hash"), "block")
        held = dealt.join(F.broadcast(wanted), "term").filter(F.array_contains("asking", F.col("question_id")))
    else:
        held = rows.join(needed, ["term", "block"])
    each = held.select("question_id", "block", "idf", F.inline(F.arrays_zip("slots", "ids", "weights")))
    summed = each.groupBy("question_id", "block", "slots", F.col("ids").alias("id")).agg(F.sum(F.col("idf") * F.col("weights")).alias("s"))
    return summed.select("question_id", "block", "slots", "id", F.round("s", 6).alias("score"))


def search_index(questions: DataFrame, index: Index, k: int = config.TOP_K, best_per_id: bool = False,
                 seed_blocks: int = SEED_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """BM25 top-k (question_id, rank, id, score), and the bounds (question_id, block, bound, scored) it was found by.

    With `best_per_id` the rows of one id are one candidate, with the score of its best row.
    """
    asked = questions.select(F.col("id").alias("question_id"), F.explode(F.array_distinct(ft.tokens(F.col("text")))).alias("term"))
    asked = materialize(asked, "asked")
    terms = asked.select("term", _folder(F.col("term")).alias("folder")).distinct()
    folders = [row.folder for row in terms.select("folder").distinct().collect()]  # at most TERM_FOLDERS
    stored = index.stored(terms.select("term")).filter(F.col("folder").isin(folders))
    rows = index.terms(stored)
    tops = materialize(index.tops(stored), "tops")
    df = tops.groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.log1p((F.lit(float(index.documents())) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    wanted = materialize(asked.join(df, "term").select("question_id", "term", idf.alias("idf")), "wanted")
    bounds = tops.join(F.broadcast(wanted) if fits(wanted) else wanted, "term")
    bounds = bounds.groupBy("question_id", "block").agg((F.sum(F.col("idf") * F.col("top")) + SLACK).alias("bound"))
    order = W.partitionBy("question_id").orderBy(F.desc("bound"), "block")
    first = materialize(bounds.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= seed_blocks), "first")
    scored = materialize(_scored(first.select("question_id", "block"), wanted, rows), "scored")

    def candidates(found: DataFrame) -> DataFrame:
        return found.groupBy("question_id", "id").agg(F.max("score").alias("score")) if best_per_id else found

    kth = rank_top(candidates(scored), k).filter(F.col("rank") == k).select("question_id", F.col("score").alias("least"))
    kth = materialize(kth, "least")
    rest = bounds.join(F.broadcast(kth) if fits(kth) else kth, "question_id", "left").filter("least IS NULL OR bound >= least")
    rest = rest.join(first.select("question_id", "block"), ["question_id", "block"], "left_anti")
    rest = materialize(rest.select("question_id", "block"), "rest")
    found = scored.unionByName(_scored(rest, wanted, rows)).select("question_id", "id", "score")
    used = first.select("question_id", "block").unionByName(rest).withColumn("used", F.lit(True))
    report = bounds.join(used, ["question_id", "block"], "left").select("question_id", "block", "bound", F.coalesce("used", F.lit(False)).alias("scored"))
    return rank_top(candidates(found), k), report
