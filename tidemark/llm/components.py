"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable over the edges (a, b), for each node with an edge.

    Each round links every node's larger neighbours, then its smaller ones, to the smallest neighbour, until
    the edges are stars.  The smallest neighbour is an aggregation with partial results, and edges meet it
    in an ordinary join, so a node with very many edges is split like any skewed key.  Rounds are stored.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), label)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()  # every edge has a > b from here on
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(
            least.select("a", F.col("m").alias("b")))
        edges = stored(small.distinct(), label)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
