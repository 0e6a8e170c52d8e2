"""Connected components of links held in Spark, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guestlens.llm.frames import stored


def connected(links: DataFrame) -> DataFrame:
    """For each node of ``links`` (a, b): id and component, the smallest node it can reach.

    Every round hangs the larger neighbours of a node, then the node itself, below its smallest
    neighbour. The smallest neighbour is an aggregate that is joined back, so the many links of
    one node are never gathered; rounds grow with the logarithm of the longest chain. Nodes
    without links to others are not listed.
    """
    stars = _oriented(links.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")))
    stars = stored(stars)
    before = None
    while (state := _state(stars)) != before:
        before = state
        stars = stored(_small_star(_large_star(stars)))
    leaves = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    return edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    hung = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    return _oriented(hung)


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return _oriented(hung.select("e.u", "e.v"))
