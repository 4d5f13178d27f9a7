"""Connected components of links in a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.store import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b longs), root being the smallest node reachable.

    Each round every node's neighbours are tied to the smallest of them, first the larger ones, then the smaller ones;
    stars are the fixed point, reached after a number of rounds logarithmic in the number of nodes. The smallest neighbour is an
    aggregate with map-side combine, so a node with a third of all links is no single task's work. Each round is written.
    """
    edges = written(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                    "links")

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    def state(pairs: DataFrame):
        return pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()

    before = state(edges)
    while before["n"]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(smallest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-stars")
        least = smallest(large)
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = written(small, "small-stars")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
