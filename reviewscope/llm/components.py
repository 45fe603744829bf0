"""Connected components of a link table, by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewscope.session import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node.

    Each round every node's larger neighbours are tied to its smallest one, then
    its smaller neighbours are: stars grow until nothing else is left, in about the
    logarithm of the longest path. Smallest neighbours are found by aggregation,
    so a node with links to a third of all nodes needs no group of its own. Links
    from a node to itself are ignored; repeated links count once.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges = materialize(edges, "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialize(large, "large-stars")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
            .where("a <> b").distinct()
        )
        edges = materialize(small, "small-stars")
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)


def merged_components(component: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after further links between nodes of ``component``, or new ones: only components are joined."""
    known = component.select(F.col("node"), F.col("component").alias("old"))
    ends = links.select("a", "b")
    for end in ("a", "b"):
        ends = ends.join(known.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("old", end)).drop("old")
    moved = materialize(connected_components(ends), "merged").select(F.col("node").alias("old"), F.col("component").alias("new"))
    kept = known.join(moved, "old", "left").select("node", F.coalesce("new", "old").alias("component"))
    fresh = moved.select(F.col("old").alias("node"), F.col("new").alias("component")).join(known, "node", "left_anti")
    return kept.unionByName(fresh)


def _stars(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has one only, which has no smaller neighbour itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").count() == 0
