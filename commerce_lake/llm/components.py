"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) of every node with an edge; component: the smallest node reachable.

    ``edges`` has columns u and v.  Each round joins the edges with
    their neighbourhoods' minima, which are aggregated on the map side
    first; the rounds grow with the logarithm of the longest path.  Each
    round's edges are checkpointed.  Loops and repeated edges are
    allowed; rows with a NULL end are left out.  Raises if the rounds do
    not suffice.
    """
    edges = checkpointed(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _digest(edges)
    for _ in range(max_rounds):
        # large star: every larger neighbour of u is linked to the smallest of u and its neighbours
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours are linked to the smallest of these
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = checkpointed(large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                             .union(least.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _digest(edges)
        if state == before:
            nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.union(edges.select("v", "v").distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
