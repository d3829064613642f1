"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climate_lake.session import materialise


def _pairs(rows: DataFrame) -> DataFrame:
    """Edges with the larger end first, once each."""
    return rows.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _pairs(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest one."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return _pairs(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for the ends of ``u, v`` edges (long): the smallest node of the component, roots excluded.

    Each round is written to the shared work folder, so that lineage stays short. Rounds go on until nothing changes;
    their number grows with the logarithm of the longest chain.
    """
    now, before = materialise(_pairs(edges), "edges"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, now = state, materialise(_small_star(_large_star(now)), "edges")
