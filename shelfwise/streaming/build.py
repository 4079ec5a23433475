"""Chunks and vectors kept in step with arriving documents, one version per micro-batch.

A micro-batch cuts and embeds the documents whose text changed and rewrites the partitions they lie in; all other
files keep their names. The batch number is part of the version, so a batch that is replayed after a crash, before or
after its commit, is applied once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.operators import chunk, infer
from shelfwise.session import discard, fits, materialize
from shelfwise.sources.versions import VersionedTable

BUCKETS = 64


@dataclass(frozen=True)
class LiveIndex:
    """A versioned table of chunks with their vectors, fed by streams of documents.

    Documents have doc_id, extracted_text, `deleted` and `arrived`; further columns in `keep` stay with the chunks.
    """

    spark: SparkSession
    path: str
    buckets: int = BUCKETS
    keep: tuple[str, ...] = ()
    dim: int = config.EMBEDDING_DIM

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.spark, self.path, "bucket")

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def latest(self, batch: DataFrame) -> DataFrame:
        """One row per document: the one that arrived last."""
        named = batch.select("doc_id", "extracted_text", "deleted", "arrived", *self.keep)
        newest = F.max_by(F.struct("extracted_text", "deleted", *self.keep), F.struct("arrived", F.xxhash64("extracted_text")))
        return named.groupBy("doc_id").agg(newest.alias("d")).select("doc_id", "d.*")

    def changed(self, docs: DataFrame) -> DataFrame:
        """Documents that are new, gone, or whose text differs from the one the stored chunks were cut from."""
        hashed = docs.withColumns({"doc_hash": F.md5(F.coalesce("extracted_text", F.lit(""))), "bucket": self.bucket(F.col("doc_id"))})
        if not self.table.numbers():
            return hashed.filter("NOT deleted")
        stored = self.table.read().select("doc_id", F.col("doc_hash").alias("held")).distinct()
        few = F.broadcast(hashed) if fits(hashed) else hashed
        held = stored.join(few.select("doc_id"), "doc_id", "left_semi")
        both = hashed.join(F.broadcast(held) if fits(held) else held, "doc_id", "left")
        return both.filter(F.when(F.col("deleted"), F.col("held").isNotNull()).otherwise(~F.col("held").eqNullSafe(F.col("doc_hash")))).drop("held")

    def apply(self, batch: DataFrame, batch_id: int | str) -> int:
        """Bring the table in step with a batch; how many documents were cut and embedded."""
        name = str(batch_id)
        if self.table.numbers() and self.table.applied(name):
            return 0
        todo = materialize(self.changed(self.latest(batch)), "todo")
        fresh = todo.filter("NOT deleted")
        chunks = chunk.with_chunk_ids(chunk.chunk_documents(fresh, "doc_id", "doc_hash", "bucket", *self.keep))
        chunks = materialize(chunks, "chunks")
        embedded = infer.embed(chunks, "chunk_content", "chunk_key", self.dim).drop("content_hash")
        self.table.upsert(todo.select("doc_id", "bucket"), embedded, "doc_id", name)
        done = fresh.count()
        discard(todo, chunks)
        return done

    def follow(self, documents: DataFrame, checkpoint: str) -> None:
        """Apply everything a stream of documents holds, then return."""
        query = (
            documents.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, number: self.apply(batch, number) and None)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
