"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, forget


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node in ``links(a, b)``.

    Every round links nodes to the smallest node that they see; it takes about as many rounds as the
    logarithm of the longest path. A node with many links is only ever reduced to a minimum, and the
    join with it can be split. Links of a node with itself only name it.
    """
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    edges = cut_lineage(
        links.filter("a != b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a"))
        .select("a", "b").distinct()
    )
    mark = None
    while True:
        new = cut_lineage(_small_star(_large_star(edges)))
        row = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        forget(edges)
        edges = new
        if tuple(row) == mark:
            break
        mark = tuple(row)
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(found, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Links of every node's larger neighbours to its smallest one."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links of every node and its smaller neighbours to the smallest of them; ``a`` is larger."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least).distinct()
