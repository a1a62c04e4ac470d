"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.workspace import settle


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Each node's neighbours linked to its smallest one: the larger of them, or the smaller."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if small:
        both = both.where("a > b")
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    linked = both.join(least, "a")
    wanted = linked if small else linked.where("b > a")
    out = wanted.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if small:
        out = out.unionByName(least.select("a", F.col("least").alias("b")))
    else:
        # a node that is the smallest around keeps its own links as they are
        out = out.unionByName(least.where("least < a").select("a", F.col("least").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`id, label` of every node of `edges(a, b)`; the label is the smallest id it can reach.

    Every round halves the longest way to the label or better. The edges are written between
    rounds, and no node's links are gathered anywhere: minima are taken before the shuffle, and a
    node with many links is a join with a skewed key, which Spark splits.
    """
    now = settle(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now = settle(_star(settle(_star(now, small=False), "edges"), small=True), "edges")
    members = now.select(F.col("a").alias("id"), F.col("b").alias("label"))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct()
    return members.unionByName(roots)
