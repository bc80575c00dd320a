"""Connected components of a graph given as rows of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` for each end of the links ``a, b``: the smallest id reachable.

    Each round hangs every node on the smallest of its neighbours: first those larger than
    it (large star), then those smaller (small star). The number of rounds grows with the
    logarithm of the longest chain. Minima are pre-aggregated in the map tasks, so that the
    centre of a large star costs no more than any other node; the join back splits under
    adaptive execution. Each round is stored in the shared folder.
    """
    ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(ends.filter("a <> b"))
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m"))
        lowest = lowest.select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
        )
        small = large.join(least, "a").select(F.inline(hung))
        edges = written(small.filter("a <> b").distinct())
        if _are_stars(edges):
            break
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other, and none on a node that hangs itself."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("hangs")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("hangs")))).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.sum("e.hangs").alias("up"), F.count_if(F.col("e.hangs") == 0).alias("down"))
    wrong = nodes.filter("up > 1 or (up > 0 and down > 0)")
    return wrong.agg(F.count("*")).first()[0] == 0
