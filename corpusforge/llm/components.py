"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusforge.llm.common import written


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label): each node of (a, b) edges with its component's smallest node.

    Each round links every node's larger neighbours to its smallest one, then
    its smaller neighbours likewise; the number of rounds grows with the
    logarithm of the longest path. The edges stay a table; the driver sees a
    count and a checksum.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, seen = written(links, "links"), None
    for _ in range(rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        links = written(small, "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if state == seen:
            break
        seen = state
    else:
        raise ValueError(f"components did not settle in {rounds} rounds")
    ends = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        ends.select("node", F.col("node").alias("label")))
