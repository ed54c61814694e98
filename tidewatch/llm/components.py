"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the component's least node.

    Each round links all larger neighbours of a node to its least neighbour, then all
    smaller ones (Kiveris et al. 2014).  A node's neighbours are never gathered: their
    minimum is an aggregate that is joined back.  Rounds are cut by checkpoints and their
    number grows as the logarithm of the longest chain.
    """
    edges = checkpointed(links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct())
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        # Now a > b in every row: a is linked to a smaller node.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = checkpointed(
            small.select("a", F.col("m").alias("b"))
            .union(small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))
            .distinct())
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct()
                       .join(roots.select(F.col("node").alias("b")), "b", "left_anti")
                       .select("b", F.col("b").alias("root")))
