"""Connected components of an edge table, by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldergrid.session import cut_lineage, forget


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b), the root being the smallest node of the
    component, roots included. Nodes without an edge do not occur.

    Every round joins the edges to the smallest neighbour of a node. Both are tables in the
    shared folder: rounds do not add up in the lineage, and a node with very many edges is a
    skewed key of a plain shuffle join, which adaptive execution splits. The number
    of rounds grows with the logarithm of the size of the largest component.
    """
    current = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    measured = _measure(current)
    while True:
        # large star: every larger neighbour is linked to the smallest neighbour
        both = current.union(current.select("b", "a"))
        least = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")))
        large = (
            both.join(least, F.col("a") == F.col("n")).where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = cut_lineage(large)
        # small star: the smaller neighbours and the node itself are linked to the smallest
        smallest = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m"))
        small = (
            large.join(smallest, F.col("a") == F.col("n")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(smallest.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()
        )
        earlier, current = current, cut_lineage(small)
        forget(earlier, least, large, smallest)
        now = _measure(current)
        if now == measured:
            break
        measured = now
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(nodes.select(F.col("root").alias("node"), "root").distinct())


def _measure(edges: DataFrame) -> tuple:
    """Number of edges and a sum over their hashes: equal if nothing changed."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
