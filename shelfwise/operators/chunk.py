"""Chunking: character-bounded, separator, heading and parent-child."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.functions import text as ft

CHUNK_TYPE = "array<struct<ordinal:int,start:int,text:string>>"


def _pieces(text: str, begin: int, end: int, separator: str) -> list[tuple[int, int]]:
    if separator == "":
        return [(i, i + 1) for i in range(begin, end)]
    spans, at = [], begin
    while at <= end:
        cut = text.find(separator, at, end)
        stop = end if cut < 0 else cut
        if stop > at:
            spans.append((at, stop))
        at = stop + len(separator)
        if cut < 0:
            break
    return spans


def _pack(spans: list[tuple[int, int]], size: int, overlap: int) -> list[tuple[int, int]]:
    """Greedy windows of whole pieces; a window is one slice of the text."""
    starts = [s for s, _ in spans]
    ends = [e for _, e in spans]
    windows, first = [], 0
    while first < len(spans):
        last = bisect_right(ends, starts[first] + size) - 1
        windows.append((starts[first], ends[last]))
        if last == len(spans) - 1:
            break
        tail = max(bisect_left(starts, ends[last] - overlap), bisect_left(starts, ends[last + 1] - size))
        first = min(max(tail, first + 1), last + 1)
    return windows


def split_spans(
    text: str,
    size: int = config.CHUNK_SIZE,
    overlap: int = config.CHUNK_OVERLAP,
    separators: tuple[str, ...] = config.SEPARATORS,
) -> list[tuple[int, int]]:
    """(start, end) of every chunk of one text, in order."""

    def split(begin: int, end: int, seps: tuple[str, ...]) -> list[tuple[int, int]]:
        at = next((i for i, s in enumerate(seps) if text.find(s, begin, end) >= 0), len(seps) - 1)
        found, run = [], []
        for span in _pieces(text, begin, end, seps[at]):
            if span[1] - span[0] <= size:
                run.append(span)
                continue
            found += _pack(run, size, overlap)
            run = []
            found += split(*span, seps[at + 1 :])
        return found + _pack(run, size, overlap)

    return split(0, len(text), separators) if text.strip() else []


def chunk_array(text: Column, size: int = config.CHUNK_SIZE, overlap: int = config.CHUNK_OVERLAP) -> Column:
    """Array of (ordinal, start, text); NULL or blank text gives an empty array, failing text NULL."""

    def pieces(text: str | None) -> list[tuple[int, str]] | None:
        try:
            spans = split_spans(text, size, overlap) if text else []
        except Exception:  # noqa: BLE001 - one bad document never fails the job; see failed_documents
            return None
        found = []
        for begin, end in spans:
            piece = text[begin:end]
            body = piece.strip()
            if body:
                found.append((begin + len(piece) - len(piece.lstrip()), body))
        return found

    def listed(texts: pa.Array) -> pa.Array:
        starts, bodies, ends, failed = [], [], [0], []
        for text in texts:
            found = pieces(text.as_py())
            failed.append(found is None)
            starts += [start for start, _ in found or ()]
            bodies += [body for _, body in found or ()]
            ends.append(len(bodies))
        ordinals = np.arange(len(bodies)) - np.repeat(ends[:-1], np.diff(ends))
        columns = [pa.array(ordinals, pa.int32()), pa.array(starts, pa.int32()), pa.array(bodies, pa.string())]
        rows = pa.StructArray.from_arrays(columns, names=["ordinal", "start", "text"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows, mask=pa.array(failed, pa.bool_()))

    @F.arrow_udf(CHUNK_TYPE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield listed(batch)

    return run(text)


def failed_documents(df: DataFrame, chunks: str) -> DataFrame:
    """Documents that could not be split, for quarantine; explode_chunks has no rows of them."""
    return df.filter(F.col(chunks).isNull()).drop(chunks).withColumn("reject_reason", F.lit("split_failed"))


def explode_chunks(df: DataFrame, chunks: str, *keep: str) -> DataFrame:
    """One row per non-empty chunk; documents without chunks vanish.

    The outer form plus the filter gives the rows of a plain explode, without the size filter Spark
    infers for that one: pushed below a shuffle, it would run the chunker a second time.
    """
    return (
        df.select(*keep, F.explode_outer(chunks).alias("c"))
        .select(*keep, F.col("c.ordinal"), F.col("c.start"), F.col("c.text").alias("chunk_content"))
        .filter("chunk_content != ''")
    )


def with_chunk_ids(df: DataFrame, doc_key: str = "doc_id") -> DataFrame:
    """Content hash plus a key that stays unique when two documents share a chunk."""
    hashed = df.withColumn("chunk_id", F.md5("chunk_content"))
    parts = F.concat_ws("|", F.col(doc_key).cast("string"), F.col("ordinal").cast("string"), "chunk_id")
    return hashed.withColumn("chunk_key", F.sha2(parts, 256))


def chunk_documents(
    df: DataFrame,
    *keep: str,
    text: str = "extracted_text",
    size: int = config.CHUNK_SIZE,
    overlap: int = config.CHUNK_OVERLAP,
) -> DataFrame:
    """Normalise, chunk and explode; all narrow, so no shuffle."""
    normal = df.withColumn("_text", ft.normalize_whitespace(F.col(text)))
    return explode_chunks(normal.withColumn("_chunks", chunk_array(F.col("_text"), size, overlap)), "_chunks", *keep)


def chunk_paragraphs(df: DataFrame, text: str, *keep: str, separator: str = "\n") -> DataFrame:
    """Naive split on a separator; blank pieces dropped."""
    return (
        df.select(*keep, F.posexplode(F.split(text, separator)).alias("ordinal", "chunk_content"))
        .withColumn("chunk_content", F.trim("chunk_content"))
        .filter("chunk_content != ''")
    )


def chunk_headings(df: DataFrame, text: str, key: str) -> DataFrame:
    """Sections bounded by markdown headings, cut inside the row: (key, section, heading, chunk_content).

    Every section keeps its heading as context; a heading without a body is a section with empty
    content. Text before the first heading is section 0, without a heading, if it says anything.
    """
    pattern = r"^\s*#{1,6}\s"
    pieces = F.split(F.concat(F.lit("\n"), F.col(text)), r"\n(?=[^\S\n]*#{1,6}[^\S\n])")
    rows = df.select(key, F.posexplode(pieces).alias("section", "piece"))
    lines = F.split("piece", "\n")
    cut = rows.select(key, F.col("section").cast("bigint").alias("section"), lines.alias("lines"))
    first = F.col("lines")[0]
    headed = (F.col("section") > 0) & first.rlike(pattern)
    body = F.when(headed, F.slice("lines", 2, F.size("lines"))).otherwise(F.col("lines"))
    trimmed = F.filter(F.transform(body, lambda line: F.trim(line)), lambda line: line != "")
    content = F.array_join(trimmed, "\n")
    heading = F.when(headed, F.trim(F.regexp_extract(first, r"^\s*#{1,6}\s+(.*)$", 1)))
    return cut.select(key, "section", heading.alias("heading"), content.alias("chunk_content")).filter(
        "heading IS NOT NULL OR chunk_content != ''"
    )


def parent_child(
    df: DataFrame, key: str, text: str, parent_size: int, size: int = config.CHUNK_SIZE, overlap: int = config.CHUNK_OVERLAP
) -> DataFrame:
    """Small chunks (id, text) with the large chunk that starts at or before each (parent_id).

    Both sizes come from the same row, so nothing is joined or shuffled.
    """
    normal = df.select(key, ft.normalize_whitespace(F.col(text)).alias("_text"))
    cut = normal.select(
        key,
        F.transform(chunk_array(F.col("_text"), parent_size, 0), lambda p: p["start"]).alias("starts"),
        chunk_array(F.col("_text"), size, overlap).alias("children"),
    )
    rows = cut.select(key, "starts", F.explode_outer("children").alias("c")).filter("c IS NOT NULL")
    parent = F.size(F.filter("starts", lambda s: s <= F.col("c.start"))) - 1
    return rows.select(
        F.concat_ws("#", key, F.col("c.ordinal").cast("string")).alias("id"),
        F.col("c.text").alias("text"),
        F.concat_ws("#", key, parent.cast("string")).alias("parent_id"),
    )


def chunk_stats(chunks: DataFrame, *by: str, limit: int = config.CHUNK_SIZE) -> DataFrame:
    size = F.length("chunk_content")
    return chunks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.min(size).alias("min_chars"),
        F.max(size).alias("max_chars"),
        F.sum(size.cast("bigint")).alias("sum_chars"),
        F.percentile(size, 0.5).alias("median_chars"),
        F.count_if(size > limit).alias("over_limit"),
    )
