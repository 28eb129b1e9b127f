"""Connected components by alternating large-star and small-star rounds (joins and minima only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.shared import landed_observed


def _measures() -> dict:
    return {"n": F.count(F.lit(1)), "mark": F.bit_xor(F.xxhash64("a", "b"))}


def star_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Rows (node, root): every node that has a link, except the roots, with the smallest node
    of its component.

    A round takes two minima per node (combined before the shuffle) and two joins, whose large
    side adaptive execution can split, so a node linked to a third of all others is no bottleneck.
    The number of rounds grows with the logarithm of the nodes. Each round is written to the
    shared folder. Links of a node with itself and repeated links are harmless.
    """
    a, b = F.greatest(left, right), F.least(left, right)
    edges = links.select(a.alias("a"), b.alias("b")).where("a > b").distinct()
    edges, before = landed_observed(edges, "component-links", **_measures())
    while before["n"]:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        merged = small.union(least.withColumnRenamed("m", "b")).distinct()
        edges, after = landed_observed(merged, "component-links", **_measures())
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
