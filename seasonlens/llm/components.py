"""Connected components of a table of links, in Spark jobs only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlens.session import stage


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node it reaches) for every node of the links (a, b).

    Alternates two steps: every larger neighbour is linked to a node's smallest neighbour,
    then every smaller one, until all that is left are stars. Each round is staged, so lineage stays short.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        edges = stage(_small_star(_large_star(edges)), "links")
        if _are_stars(edges):
            break
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every edge (a > b) is the only one of its a and ends in a node that has none: both steps would change nothing."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return nodes.agg(F.count_if(F.expr("below > 1 or below > 0 and above > 0"))).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges (a > b): every neighbour above a node moves to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, move to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
