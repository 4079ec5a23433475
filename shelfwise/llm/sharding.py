"""Sharding along a Hilbert curve, in DataFrame functions only.

Every metadata dimension is quantised to 2^bits levels of about equal row counts (exact running counts over
its distinct values; sizes count by their square root, so at most 46,341 values). The cell of a row in the
grid has a position on the Hilbert curve; rows are sorted by it and the sorted run is cut in shards with
row counts at most one apart. Rows of one shard are near each other in all dimensions, so file statistics
prune on any of them.

Ranks come from ranges of the sort key, which ends in id and checksum: a cell with a third of all rows is spread over
many ranges. Only narrow columns are ranked.

Defined results: a null dimension is a value of its own, before all others; a null text has no bytes and the
checksum of the empty text; equal rows get different slots; fewer rows than shards leave shards empty;
an empty table gives no rows; other columns are ignored by `assign_shards` and kept by `shard_documents`
(which adds `shard` and `curve` unless the documents have columns of these names).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.ordering import ranked, running_total
from shelfwise.session import fits, materialize
from shelfwise.sources.tables import table

SHARDS = 24
BITS = 4
LAW = "rows"


def quantise(rows: DataFrame, dimension: str, total: int, bits: int = BITS) -> DataFrame:
    """rows with `<dimension>_level`: 0 to 2^bits - 1 by the share of rows with a smaller value."""
    counts = rows.groupBy(dimension).agg(F.count(F.lit(1)).alias("n"))
    levels = running_total(counts, [F.col(dimension).asc_nulls_first()], "n")
    level = F.floor(F.col("before") * F.lit(1 << bits) / F.lit(max(total, 1))).cast("int").alias(f"{dimension}_level")
    levels = materialize(levels.select(F.col(dimension).alias("_value"), level), "levels")
    levels = F.broadcast(levels) if fits(levels) else levels
    return rows.join(levels, rows[dimension].eqNullSafe(F.col("_value"))).drop("_value")


def curve_position(axes: Column, dimensions: int, bits: int) -> Column:
    """Position on the Hilbert curve of a point: array of `dimensions` coordinates of `bits` bits.

    Walks the bits from the highest down, undoing the rotation and reflection of each sub-cube, then reads the
    Gray code across the axes.
    """
    steps = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(dimensions)]

    def turn(point: Column, step: Column) -> Column:
        bit, axis = step["bit"], step["axis"]
        low, first, own = bit - 1, F.get(point, F.lit(0)), F.get(point, step["axis"])
        swapped = first.bitwiseXOR(own).bitwiseAND(low)
        return F.transform(
            point,
            lambda value, i: F.when(
                own.bitwiseAND(bit) != 0, F.when(i == 0, value.bitwiseXOR(low)).otherwise(value)
            ).otherwise(F.when((i == 0) | (i == axis), value.bitwiseXOR(F.when(axis == 0, 0).otherwise(swapped))).otherwise(value)),
        )

    listed = F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(i).alias("axis")) for b, i in steps]) if steps else None
    turned = F.aggregate(listed, axes, turn) if steps else axes
    gray = F.aggregate(
        turned,
        F.array().cast("array<int>"),
        lambda done, v: F.array_append(done, v.bitwiseXOR(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)))),
    )
    falls = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]) if bits > 1 else F.array().cast("array<int>")
    flip = F.aggregate(
        falls, F.lit(0), lambda t, q: F.when(F.get(gray, F.lit(dimensions - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)
    )
    places = [
        F.shiftleft(F.shiftright(F.get(gray, F.lit(i)).bitwiseXOR(flip), b).bitwiseAND(1).cast("bigint"), b * dimensions + dimensions - 1 - i)
        for b in range(bits)
        for i in range(dimensions)
    ]
    return reduce(lambda a, b: a + b, places)


def curve_table(spark: SparkSession, dimensions: int, bits: int = BITS) -> DataFrame:
    """(cell, curve) for each of the 2^(dimensions * bits) cells of the grid: a fixed number of rows."""
    cells = spark.range(1 << (dimensions * bits)).withColumnRenamed("id", "cell")
    mask = (1 << bits) - 1
    axes = F.array(*[F.shiftright("cell", bits * i).bitwiseAND(mask).cast("int") for i in range(dimensions)])
    return cells.select("cell", curve_position(axes, dimensions, bits).alias("curve"))


def curve_order(rows: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """rows with `curve`, the position of their cell on the curve."""
    total = rows.count()
    for dimension in dimensions:
        rows = quantise(rows, dimension, total, bits)
    levels = [F.shiftleft(F.col(f"{d}_level").cast("bigint"), bits * i) for i, d in enumerate(dimensions)]
    rows = rows.withColumn("cell", reduce(lambda a, b: a + b, levels))
    return rows.join(F.broadcast(curve_table(rows.sparkSession, len(dimensions), bits)), "cell").drop("cell")


def described(docs: DataFrame, id_col: str, text_col: str, dimensions: list[str], keep: list[str] = ()) -> DataFrame:
    """id, size, checksum, one column per dimension (the size by its square root), and the columns to keep."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.col(d).cast("string").alias(f"dim{i}") for i, d in enumerate(dimensions)],
        F.floor(F.sqrt(F.octet_length(text))).cast("int").alias(f"dim{len(dimensions)}"),
        *keep,
    )


SORT = ("curve", "id", "text_crc32", "size")


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dimensions: tuple[str, ...] = ("source", "lang"),
                  shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Per document: id, size, text_crc32, curve, rank, shard and slot (gapless from 0 in its shard)."""
    rows = materialize(described(docs, id_col, text_col, list(dimensions)), "described")
    total = rows.count()
    ordered = curve_order(rows, [f"dim{i}" for i in range(len(dimensions) + 1)], bits)
    placed = ranked(ordered.select("id", "size", "text_crc32", "curve"), [F.col(c).asc_nulls_first() for c in SORT])
    shard = F.expr(f"rank * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("rank") - first)


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dimensions: tuple[str, ...] = ("source", "lang"),
                    shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """The documents with `shard` and `curve`, dealt and sorted in curve order for writing; one shuffle of the texts.

    The shards' first rows, at most `shards` of them, are the cuts; each document is compared with them where it is read.
    Equal rows stay in one shard here.
    """
    names = [f"dim{i}" for i in range(len(dimensions) + 1)]
    narrow = materialize(described(docs, id_col, text_col, list(dimensions)), "described")
    total = narrow.count()
    levels = curve_order(narrow, names, bits)
    placed = ranked(levels.select(*SORT), [F.col(c).asc_nulls_first() for c in SORT])
    wanted = sorted({-(-i * total // shards) for i in range(1, shards)} - {total})
    cuts = placed.filter(F.col("rank").isin(wanted)).orderBy("rank").collect() if wanted else []
    cells = materialize(levels.select(*names, "curve").distinct(), "cells")  # by value, not by row
    cells = F.broadcast(cells) if fits(cells) else cells
    keyed = described(docs.select(F.struct(*docs.columns).alias("_shard_row"), *docs.columns), id_col, text_col, list(dimensions), ["_shard_row"])
    matched = [keyed[n].eqNullSafe(F.col(f"_{n}")) for n in names]
    keyed = keyed.join(cells.select(*[F.col(n).alias(f"_{n}") for n in names], "curve"), matched)
    own = F.struct(*[F.col(c) for c in SORT])
    types = {f.name: f.dataType for f in placed.schema}
    shard = reduce(
        lambda total, cut: total + (own >= F.struct(*[F.lit(cut[c]).cast(types[c]).alias(c) for c in SORT])).cast("int"),
        cuts,
        F.lit(0),
    )
    dealt = keyed.withColumn("shard", shard).repartitionByRange(F.col("shard"), *[F.col(c).asc_nulls_first() for c in SORT])
    dealt = dealt.sortWithinPartitions("shard", *[F.col(c).asc_nulls_first() for c in SORT])
    extra = [c for c in ("shard", "curve") if c not in docs.columns]
    return dealt.select(*[F.col("_shard_row")[c].alias(c) for c in docs.columns], *extra)


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


QUERIES = {"op10_shard": op10_shard}
ORACLE: dict[str, str] = {}
