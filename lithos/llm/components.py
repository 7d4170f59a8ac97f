"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithos.llm._spark import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: each node's neighbours (the larger, or the smaller with itself) are linked to its least neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a != b").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b", scratch: Scratch | None = None) -> DataFrame:
    """``node, component`` of each node that has a link; ``component`` is the least node it reaches.

    Each round is written to the shared folder and the one before deleted, so lineage stays short and lost
    executors cost little; the rounds grow with the logarithm of the longest chain. A hub's links are never gathered
    in one row: minima are combined before the shuffle, and the join that follows can split a hot key. Null
    ends and links of a node to itself are left out; repeated links count once; no links give no rows.
    The last round's table stays until ``scratch`` drops it.
    """
    scratch = scratch or Scratch(links.sparkSession)
    ends = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a != b")
    edges = scratch.write(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        last, edges = edges, scratch.write(_star(_star(edges, True), False), "links")
        scratch.drop(last)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
