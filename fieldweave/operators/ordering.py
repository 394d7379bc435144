"""Orders of the nodes of a graph: whole components at once, level by level, and no global sort in one task."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import kept
from .components import components_of_dense


def numbered(rows: DataFrame, order: list[str], name: str, first: int = 0) -> DataFrame:
    """rows with their place in an order that has no ties: ranges are sorted apart, and only a row a range meets in one task."""
    cut = kept(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    starts = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1 + F.col("_start") + first
    return cut.join(F.broadcast(starts), "_range").withColumn(name, place.cast("long")).drop("_range", "_start")  # a row a range


def quantiles(rows: DataFrame, key: str, value: str, shares: dict[str, float]) -> DataFrame:
    """key and interpolated quantiles of each key's values, named as in `shares`; nulls do not count.

    Equal values are counted, ranges of (key, value) are sorted apart, and only a row a range and key meets in one task."""
    counts = rows.groupBy(F.col(key).alias("_key"), F.col(value).alias("_value")).agg(F.count(value).alias("_n"))
    cut = kept(counts.repartitionByRange("_key", "_value").withColumn("_range", F.spark_partition_id()))
    before = F.sum("_m").over(W.partitionBy("_of").orderBy("_at").rowsBetween(W.unboundedPreceding, -1))
    starts = cut.groupBy(F.col("_key").alias("_of"), F.col("_range").alias("_at")).agg(F.sum("_n").alias("_m"))
    starts = starts.select("_of", "_at", F.coalesce(before, F.lit(0)).alias("_start"), F.sum("_m").over(W.partitionBy("_of")).alias("_all"))
    upto = F.sum("_n").over(W.partitionBy("_key", "_range").orderBy("_value").rowsBetween(W.unboundedPreceding, 0)) + F.col("_start")
    met = F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at"))
    placed = cut.join(F.broadcast(starts), met).withColumn("_end", upto)  # a row a range and key
    parts = []
    for name, share in shares.items():
        place = (F.col("_all") - 1) * share
        at = lambda k: F.max(F.when((k >= F.col("_end") - F.col("_n")) & (k < F.col("_end")), F.col("_value")))
        parts += [at(F.floor(place)).alias(f"_low_{name}"), at(F.ceil(place)).alias(f"_high_{name}"), F.max(place - F.floor(place)).alias(f"_part_{name}")]
    mixed = lambda n: F.col(f"_low_{n}") * (1 - F.col(f"_part_{n}")) + F.col(f"_high_{n}") * F.col(f"_part_{n}")
    return placed.groupBy("_key").agg(*parts).select(F.col("_key").alias(key), *[mixed(n).alias(n) for n in shares])


def banded_order(edges: DataFrame) -> DataFrame:
    """node, degree, level, position: the reverse Cuthill-McKee order of the nodes of undirected edges (sender, receiver).

    Each component starts at its node of least degree, ties to the smallest id. A level holds the nodes next to the level
    before, in order of the first of them to which they are joined, then of their own degree, then of their id. Components
    follow each other in the order of their starts; at last positions are counted from the end. Edges of a node to
    itself and repeated ones count for nothing but the node's being there; null ends are left out. All components advance
    in the same jobs: some for the components, as many as the logarithm of their span, and one a level."""
    ends = edges.select(F.least("sender", "receiver").alias("u"), F.greatest("sender", "receiver").alias("v")).where("sender IS NOT NULL AND receiver IS NOT NULL")
    once, spark = kept(ends.distinct()), edges.sparkSession
    pairs = once.unionByName(once.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Links lie by their first ends for all that follows: only what meets them moves.
    links = pairs.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), "u").persist(StorageLevel.DISK_ONLY)
    nodes = kept(links.groupBy(F.col("u").alias("node")).agg(F.sum((F.col("u") != F.col("v")).cast("long")).alias("degree")))
    links_of_two = links.where("u <> v")
    # The start of a component is the least (degree, node) in it.
    rooted = nodes.join(components_of_dense(links_of_two), "node", "left").withColumn("root", F.coalesce("root", "node"))
    starts = rooted.groupBy("root").agg(F.min(F.struct("degree", "node")).alias("start"))
    named = kept(rooted.join(starts, "root").select("node", "degree", "start"))
    level, done = 0, None
    frontier = named.where("node = start.node").withColumn("first", F.lit(0).cast("long"))
    order = ["start", "first", "degree", "node"]
    while True:
        placed = kept(numbered(frontier, order, "place").select("node", "degree", "start", F.lit(level).alias("level"), "place"))
        if not placed.limit(1).count():
            break
        done = placed if done is None else done.unionByName(placed)
        reached = links_of_two.join(placed.select(F.col("node").alias("u"), "place"), "u").groupBy(F.col("v").alias("node")).agg(F.min("place").alias("first"))
        # Neighbours of a level lie in it, in the one before or in the next.
        recent = placed.select("node") if level == 0 else placed.select("node").unionByName(last.select("node"))
        frontier, last, level = named.join(reached, "node").join(recent, "node", "left_anti"), placed, level + 1
    links.unpersist()
    if done is None:
        return nodes.select("node", "degree", F.lit(0).alias("level"), F.lit(0).cast("long").alias("position"))
    whole = numbered(done, ["start", "level", "place"], "ahead")
    return whole.select("node", "degree", "level", (F.lit(nodes.count() - 1) - F.col("ahead")).alias("position"))


def renumbered(edges: DataFrame, order: DataFrame) -> DataFrame:
    """Edges whose ends are named by their positions."""
    at = lambda c: order.select(F.col("node").alias(c), F.col("position").alias(f"{c}_position"))
    return edges.join(at("sender"), "sender").join(at("receiver"), "receiver")
