"""Connected components of an edge table by alternating large-star and small-star rounds.

A round is two aggregates and two joins. Minima are combined before the shuffle and no neighbourhood is gathered.
The minima are a written table when edges meet them: broadcast after a size check, else a plain join of two
shuffled tables, whose hot keys (a vertex with a third of all edges) Spark splits. Rounds grow with the
logarithm of the number of vertices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import fits, materialize


def _settled(edges: DataFrame) -> bool:
    """True for a forest of stars: every vertex points to one other at most, and none is pointed to that points itself."""
    seen = edges.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    counted = seen.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return counted.filter("below > 1 OR (below > 0 AND above > 0)").isEmpty()


def _least(edges: DataFrame, value) -> DataFrame:
    """(u, m): the smallest neighbour of every vertex, as a table of its own."""
    least = materialize(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", value.alias("m")), "least")
    return F.broadcast(least) if fits(least) else least


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, F.least("u", "m"))
    moved = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down, F.col("m"))
    linked = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every vertex of `edges` (u, v: bigint) that is not the smallest of its component, with the smallest."""
    edges = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _settled(edges):
        edges = materialize(_small_star(materialize(_large_star(edges), "stars")), "edges")
    return edges
