"""Connected components of links between whole-numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import checkpointed


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); a component is named by its smallest node.

    Large and small stars in turn: a node's larger neighbours, then its smaller ones, are linked to the
    smallest node among its neighbours. Links never grow in number beyond a row per link, rounds grow with
    the logarithm of a component's width, and what is known after a round is stored, so a lost executor
    repeats a round at most. Minima are folded before the shuffle; a hot node's rows meet its minimum in a
    join that adaptive execution can split.
    """
    edges = checkpointed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = checkpointed(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        # A fixed point is a star per component: as many links as nodes besides the centres, unchanged.
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    leaves = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(centres)
