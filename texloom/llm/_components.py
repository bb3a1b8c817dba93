"""Connected components of a graph given by its edges, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ._cluster import cut


#: Edges of a checkpoint's file.
ROWS = 1 << 17


def _seen(edges: DataFrame) -> Row:
    """(number, sum of hashes) of edges."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): the smallest node of its component.

    Alternates two steps (large star and small star): every node's larger neighbours, then all its smaller
    ones, are tied to the smallest node it knows. The smallest neighbour is an aggregation with partial
    results, and edges meet it in a join whose large partitions can be split, so a node with very many
    neighbours is not gathered. Each round is checkpointed, in as many files as its edges need: the edges of a round have
    their number from the round before, which they hardly exceed. Ends when nothing changes: all edges then point at the
    smallest node.
    """
    cores = edges.sparkSession.sparkContext.defaultParallelism
    edges = cut(edges.filter("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _seen(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                 .unionByName(down.select("a", F.col("m").alias("b"))).distinct())
        edges = cut(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
                    .coalesce(max(cores, -(-seen[0] // ROWS))))
        now = _seen(edges)
        if now == seen:
            break
        seen = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
