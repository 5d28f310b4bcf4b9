"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import Scratch


def _stars(edges: DataFrame) -> bool:
    """Whether every vertex points to one root and no root points further."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down > 1 or (down = 1 and up = 1)").isEmpty()


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is tied to the least vertex around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Roots of the vertices that have links.

    ``links``: columns ``u, v`` (any orderable type; either order; repeats are
    harmless). Returns ``id, root`` for every vertex with a link to another
    one; ``root`` is the least vertex of its component. No links: no rows.

    Only (vertex, least) edges move: no neighbour list is ever gathered, and a
    hot vertex is a partial minimum plus a join that AQE can split. Every round
    is written to the shared folder.
    """
    edges, k = scratch.save(_small(links), f"{name}-0"), 0
    while not _stars(edges):
        k += 1
        edges = scratch.save(_small(_large(edges)), f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
