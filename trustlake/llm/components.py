"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.session import lineage_cut


def _turned(edges: DataFrame) -> DataFrame:
    """Each edge from its larger to its smaller end."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _star(both: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or the smaller) neighbours of a node, and in the latter case the node, on its least neighbour."""
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select("a", F.least("a", "low").alias("low"))
    hung = both.join(least, "a")
    if large:
        return hung.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return hung.filter("b <= a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
        least.select("a", F.col("low").alias("b"))
    )


def _print(edges: DataFrame) -> tuple:
    """A fingerprint of the edge set."""
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 20))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge, the root being the least node of the component.

    ``edges`` has bigint columns ``a`` and ``b``; direction, loops and repeats do not matter. Alternating large and small
    star operations turn every component into a star within a few rounds; the edges never grow in number. Each round is
    stored in the shared folder, so a lost executor costs one round at most.
    """
    edges = lineage_cut(_turned(edges))
    seen = _print(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = lineage_cut(_turned(_star(both, large=True)))
        edges = lineage_cut(_turned(_star(large, large=False)))
        now = _print(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
