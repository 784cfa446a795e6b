"""Connected components of an edge table by alternating large-star and
small-star rounds (published MapReduce method): every round is two grouped
minima and two joins, the edge set is written to the shared folder between
rounds, and the number of rounds grows with the logarithm of the graph.  No
node's neighbours are ever gathered, so a hub costs no more memory than a leaf.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _toward_minimum(links: DataFrame) -> DataFrame:
    """(u, v) links with, per u, the smallest of u and its v's."""
    low = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return links.join(low, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _toward_minimum(both)
    return near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _toward_minimum(down)
    own = near.select("u", F.col("m").alias("v"))
    rest = near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.union(rest).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge of two different nodes; ``root`` is
    the smallest node of its component.  Nodes without such an edge are not
    listed; an edge table without rows gives no rows; repeated edges,
    both directions of an edge and self-loops change nothing.  Edges with a null
    end are ignored."""
    cur = written(edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v")).distinct(), "edges")
    seen = _signature(cur)
    while seen[0]:
        cur = written(_small_star(written(_large_star(cur), "large-star")), "small-star")
        now = _signature(cur)
        if now == seen:
            break
        seen = now
    stars = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(cur.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
