"""Connected components of any graph of edges, by alternating stars over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.sources.scratch import dropped, kept


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (the smallest node that edges reach) of every node of the edges (a, b); nodes may be of any
    type that has an order.

    A round hangs each node's larger neighbours on its smallest one, then its smaller neighbours; the edges
    settle on the roots in about the logarithm of the longest way. Each round's table replaces the one
    before. It raises if they don't settle.
    """
    ends = edges.select("a", "b").filter("a is not null and b is not null")
    nodes = ends.select(F.col("a").alias("node")).unionByName(ends.select(F.col("b").alias("node"))).distinct()
    now = kept(ends.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = state(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        new = kept(small.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        dropped(now)
        now, before, seen = new, seen, state(new)
        if seen == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
