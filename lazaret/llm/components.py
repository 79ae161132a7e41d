"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lazaret.llm.tables import cut


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for each node of ``links`` (a, b, both long and not null): root is the smallest node it reaches.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones. Both keep the components; the links end as stars around the
    roots, after about log(nodes) rounds. A hub's links are only counted and compared through partial
    aggregates and a join on the hub; no task gathers them. Each round is a written table.
    """
    edges = cut(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), label
    )
    while True:
        # Large star: larger neighbours of each node go to its smallest neighbour or itself.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        new = cut(small.select("e.a", "e.b").filter("a > b").distinct(), label)
        if _digest(new) == _digest(edges):
            break
        edges = new
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select("root", "root").distinct())


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
