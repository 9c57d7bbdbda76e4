"""Connected components of an edge table, by alternating large and small stars.

Each step replaces edges by edges to a smaller neighbour, so paths shorten by halves and the
table never grows. Steps group by node with partial aggregation; a node with very many edges
is a hot key of a join alone, which adaptive execution splits. Every step is written to the
shared folder. The driver sees one answer per step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import stored


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node that has none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up = 1 and down = 1)").limit(1).count() == 0


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the least of these. In: u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, files_: int | None = None) -> DataFrame:
    """``node`` and ``component`` (its least node) for every node with an edge that is not the
    least itself. ``edges`` has two columns of one type; nulls and loops are ignored. ``files_``
    is how many files the edges fill at most, if that is known."""
    a, b = edges.columns
    edges = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    edges = stored(edges, "edges", files_)
    while not _settled(edges):
        edges = stored(_small(_large(edges)).distinct(), "edges", files_)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
