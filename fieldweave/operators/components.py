"""Connected components by rounds of joins, as many as the logarithm of what they span."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import kept


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for the nodes of the links (u, v); nodes are of any type that has an order.

    Large-star and small-star rounds: all neighbours of a node move to the smallest of them, until only stars are left.
    Minima are combined before they are shuffled, and a hub's links meet them by an ordinary join."""
    now = kept(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), name="links")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    was = mark(now)
    while was[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        now = kept(small.select("e.u", "e.v").where("u <> v").distinct(), name="stars")
        if (mark_now := mark(now)) == was:
            break
        was = mark_now
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def components_of_dense(links: DataFrame) -> DataFrame:
    """The same for links that are many more than their nodes, each in both directions: every node is first joined to its least
    neighbour alone, and the rounds then run on the distinct links between the groups that this gives, two nodes at least each."""
    first = kept(components(links.groupBy("u").agg(F.min("v").alias("v"))))
    at = lambda c: first.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))
    between = links.where("u < v").join(at("u"), "u").join(at("v"), "v").where("_u <> _v")
    second = components(between.select(F.col("_u").alias("u"), F.col("_v").alias("v"))).select(F.col("node").alias("root"), F.col("root").alias("_least"))
    return first.join(second, "root", "left").select("node", F.coalesce("_least", "root").alias("root"))
