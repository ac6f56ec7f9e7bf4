"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.shared import packed


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Alternates large-star and small-star steps: every step points the
    neighbours of a node at the smallest of them, so that the longest chain
    shrinks by a constant factor a round. Each step is a partly aggregated
    minimum and one join on the node, which AQE splits where a node has very
    many links. Nodes may be of any type with an order; links to itself or with
    a null end are left out.
    """
    edges = packed(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .distinct()
    )
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        edges = packed(
            small.select("u", F.col("m").alias("v"))
            .unionByName(small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"links did not settle in {rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
