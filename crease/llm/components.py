"""Connected components of an edge table by alternating large and small stars.

Every round is a grouped minimum (combined before its shuffle) and a join; no
labels, links or components pass through the driver, only the count of nodes
that are not settled.  A node with a third of all edges is a skewed join
key that adaptive execution splits: both join sides are stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm._common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges ``(u, v)`` with ``v < u``."""
    around = edges
    if large:
        around = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"),
                                                                 F.col("u").alias("v")))
    least = saved(around.groupBy("u").agg(F.min("v").alias("low"))
                  .select("u", F.least("u", "low").alias("low")), "least")
    joined = around.join(least, "u")
    if large:  # what it gives twice, the small star takes out
        return saved(joined.where("v > u AND low < v")
                     .select(F.col("v").alias("u"), F.col("low").alias("v")), "star")
    out = joined.select(F.explode(F.array(
        F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
        F.struct(F.col("u").alias("u"), F.col("low").alias("v")))).alias("e")).select("e.u", "e.v")
    return saved(out.where("v < u").distinct(), "star")


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and those that have one
    are nobody's smaller neighbour: then that neighbour is its component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"),
                                  F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR (up = 1 AND down = 1)").agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)``: the smallest node
    reachable.  Self-links and NULL ends are ignored; repeated links count once."""
    now = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("a <> b").distinct(), "edges")
    while not _settled(now):
        now = _star(_star(now, large=True), large=False)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return saved(now.select(F.col("u").alias("node"), F.col("v").alias("component"))
                 .unionByName(roots), "components")
