"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the node's smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root"))
    return (
        both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("root").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    least = down.groupBy("u").agg(F.min("v").alias("root"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("root").alias("v"))
    return moved.unionByName(least.select("u", F.col("root").alias("v")))


def _stars(edges: DataFrame) -> DataFrame:
    return _small_star(_large_star(edges)).where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v): each node with a link and the smallest node of its component, the roots left out.

    ``links`` has columns u and v of one orderable type.  Each pass groups and joins on nodes; a
    node with very many links is pre-aggregated in the one and split by the skew join in the
    other.  Passes go on until nothing changes.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    edges = stored(edges.distinct(), "components")
    before = None
    while True:
        digest = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if digest == before:
            return edges
        before = digest
        edges = stored(_stars(edges), "components")
