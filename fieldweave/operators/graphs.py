"""Typed graphs as node and edge tables: gathers, segment sums, neighbour searches, meshes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import kept, ship


def gather(edges: DataFrame, nodes: DataFrame, index: str, key: str, feature: str, fill: float, name: str) -> DataFrame:
    """The feature of the node that each edge names; `fill` where there is none."""
    looked_up = nodes.select(F.col(key).alias(index), F.col(feature).alias(name))
    return edges.join(looked_up, index, "left").withColumn(name, F.coalesce(name, F.lit(fill)))


def segment_sum(rows: DataFrame, segment: str, value: str, segments: DataFrame, name: str) -> DataFrame:
    """Sums by segment, 0 for segments without rows. Rows are summed before they meet the segments."""
    return segments.join(rows.groupBy(segment).agg(F.sum(value).alias(name)), segment, "left").withColumn(name, F.coalesce(name, F.lit(0.0)))


def within_radius(points: DataFrame, vertices: DataFrame, radius: float) -> DataFrame:
    """Pairs (vec_id, vertex_id, distance) at a chord distance up to the radius.

    Space is cut into cubes of side radius; a vertex is sent to the 27 cubes around it, a point to its own."""
    cube = lambda c: F.floor(F.col(c) / radius).cast("int")
    near = vertices.select(F.col("vec_id").alias("vertex_id"), *[F.col(c).alias(f"v{c}") for c in "xyz"], *[F.explode(F.sequence(cube(c) - 1, cube(c) + 1)).alias(f"c{c}") if c == "x" else cube(c).alias(f"o{c}") for c in "xyz"])
    for c in "yz":
        near = near.withColumn(f"c{c}", F.explode(F.sequence(F.col(f"o{c}") - 1, F.col(f"o{c}") + 1)))
    own = points.select("vec_id", *"xyz", *[cube(c).alias(f"c{c}") for c in "xyz"])
    d = F.sqrt(sum(((F.col(c) - F.col(f"v{c}")) * (F.col(c) - F.col(f"v{c}")) for c in "xyz"), F.lit(0.0)))
    return own.join(near.drop("oy", "oz"), ["cx", "cy", "cz"]).withColumn("distance", d).where(F.col("distance") <= radius).select("vec_id", "vertex_id", "distance")


def face_edges(faces: DataFrame, a: Column, b: Column, c: Column) -> DataFrame:
    """The three directed edges of each face."""
    pair = lambda s, r: F.struct(s.alias("sender"), r.alias("receiver"))
    return faces.select(F.explode(F.array(pair(a, b), pair(b, c), pair(c, a))).alias("e")).select("e.*")


def attention(edges: DataFrame, receiver: str, logit: Column, value: Column) -> DataFrame:
    """Softmax over each receiver's edges, applied to a value. The greatest logit is taken off first; both passes combine
    partial sums before they shuffle, so a receiver of many edges is no hot key."""
    rows = edges.withColumns({"_logit": logit, "_value": value})
    tops = rows.groupBy(receiver).agg(F.max("_logit").alias("_top"))
    w = F.exp(F.col("_logit") - F.col("_top"))
    return rows.join(tops, receiver).groupBy(receiver).agg(F.count(F.lit(1)).alias("edges"), (F.sum(w * F.col("_value")) / F.sum(w)).alias("attended"))


def adjacency(edges: DataFrame, sender: str, receiver: str, self_edges: bool = False) -> DataFrame:
    """Distinct (sender, receiver); with every node that has an edge joined to itself if asked for."""
    pairs = edges.select(F.col(sender).alias("sender"), F.col(receiver).alias("receiver"))
    if self_edges:
        loops = pairs.select(F.explode(F.array("sender", "receiver")).alias("sender")).distinct()
        pairs = pairs.unionByName(loops.withColumn("receiver", F.col("sender")))
    return pairs.distinct()


def block_diagonals(edges: DataFrame, block: int) -> DataFrame:
    """Edges (sender, receiver numbers) cut into square blocks: the entries of each block on the diagonal or beside it."""
    cut = edges.select(F.expr(f"sender div {block}").alias("row"), (F.expr(f"receiver div {block}") - F.expr(f"sender div {block}")).alias("side"))
    return cut.where(F.abs("side") <= 1).groupBy("row", "side").agg(F.count(F.lit(1)).alias("entries"))


def k_hop(edges: DataFrame, hops: int, self_edges: bool = True) -> DataFrame:
    """(sender, receiver, hops): pairs of nodes that a walk of so many edges joins, hops the least number; a node reaches
    itself in 0 if self_edges.

    Semi-naive: only pairs found in the last round meet the edges again, and pairs seen before are taken off, so a round
    costs what it finds. Rounds are tables, `hops` of them at most."""
    pairs = kept(edges.select("sender", "receiver").distinct())
    nodes = pairs.select(F.explode(F.array("sender", "receiver")).alias("sender")).distinct()
    seen = [nodes.select("sender", F.col("sender").alias("receiver"), F.lit(0).alias("hops"))] if self_edges else []
    newest = pairs.withColumn("hops", F.lit(1))
    onward = pairs.select(F.col("sender").alias("receiver"), F.col("receiver").alias("next"))
    for n in range(1, hops + 1):
        if n > 1:
            newest = newest.join(onward, "receiver").select("sender", F.col("next").alias("receiver")).distinct().withColumn("hops", F.lit(n))
        if seen:
            newest = newest.join(reduce(DataFrame.unionByName, seen), ["sender", "receiver"], "left_anti")
        newest = kept(newest)
        seen.append(newest)
        if newest.isEmpty():
            break
    return reduce(DataFrame.unionByName, seen) if seen else pairs.withColumn("hops", F.lit(0)).limit(0)


def block_attention(nodes: DataFrame, edges: DataFrame, block: int, scale: float | None = None) -> DataFrame:
    """(receiver, edges, attended): softmax over each receiver's edges of its q with the senders' k, applied to their v.

    nodes: node (whole numbers from 0), q, k, v (arrays); edges: sender, receiver, no farther apart than a neighbouring block.
    Nodes lie in dense blocks; a block of receivers meets the senders' blocks beside it (offsets -1, 0, 1) as matrices, each
    meeting gives every receiver the greatest logit, the sum of weights and the weighted v relative to it, and the three
    are merged by their maxima. So no edge moves with its vectors: a vector is sent three times at most."""
    ship(nodes.sparkSession)
    of = lambda c: F.expr(f"{c} div {block}")
    pairs = edges.select("sender", "receiver").distinct().select(of("receiver").alias("row"), (of("sender") - of("receiver")).alias("side"), F.struct(F.expr(f"receiver % {block}").cast("int").alias("i"), F.expr(f"sender % {block}").cast("int").alias("j")).alias("cell"))
    within = F.when(F.abs("side") > 1, F.raise_error(F.lit("an edge is longer than a block")).cast("int")).otherwise(0)
    mask = pairs.where(within == 0).groupBy("row", "side").agg(F.collect_list("cell").alias("cells"))  # block * block at most
    stacked = nodes.groupBy(of("node").alias("at")).agg(F.sort_array(F.collect_list(F.struct(F.expr(f"node % {block}").cast("int").alias("i"), "q", "k", "v"))).alias("nodes"))
    asking = stacked.select(F.col("at").alias("row"), F.transform("nodes", lambda n: F.struct(n["i"].alias("i"), n["q"].alias("x"))).alias("asking"))
    asked = stacked.select((F.col("at")).alias("row_asked"), F.transform("nodes", lambda n: F.struct(n["i"].alias("i"), n["k"].alias("x"), n["v"].alias("v"))).alias("asked"))
    met = mask.withColumn("row_asked", F.col("row") + F.col("side")).join(asking, "row").join(asked, "row_asked")
    parts = met.select("row", "cells", "asking", "asked").mapInPandas(lambda batches: _block_parts(batches, block, scale), "receiver long, n long, top double, weight double, total array<double>")
    both = parts.groupBy("receiver").agg(F.max("top").alias("top"), F.sum("n").alias("edges"), F.collect_list(F.struct("top", "weight", "total")).alias("parts"))  # three at most
    share = lambda p: F.exp(p["top"] - F.col("top"))
    weight = F.aggregate("parts", F.lit(0.0), lambda a, p: a + p["weight"] * share(p))
    total = F.aggregate(F.slice("parts", 2, 2), F.transform(F.col("parts")[0]["total"], lambda x: x * share(F.col("parts")[0])), lambda a, p: F.zip_with(a, p["total"], lambda x, y: x + y * share(p)))
    return both.withColumn("_weight", weight).select("receiver", "edges", F.transform(total, lambda x: x / F.col("_weight")).alias("attended"))


def _block_parts(batches: Iterator[pd.DataFrame], block: int, scale: float | None) -> Iterator[pd.DataFrame]:
    def matrix(rows, name: str) -> np.ndarray:
        out = np.zeros((block, len(rows[0][name])))
        out[[r["i"] for r in rows]] = [r[name] for r in rows]
        return out

    for pdf in batches:
        for row, cells, asking, asked in zip(pdf["row"], pdf["cells"], pdf["asking"], pdf["asked"], strict=True):
            q, k, v = matrix(asking, "x"), matrix(asked, "x"), matrix(asked, "v")
            mask = np.zeros((block, block), bool)
            mask[[c["i"] for c in cells], [c["j"] for c in cells]] = True
            there = np.zeros((block, block), bool)
            there[np.ix_([r["i"] for r in asking], [r["i"] for r in asked])] = True
            mask &= there
            own = np.flatnonzero(mask.any(axis=1))
            logits = np.where(mask, q @ k.T * (q.shape[1] ** -0.5 if scale is None else scale), -np.inf)[own]
            top = logits.max(axis=1) if len(own) else np.zeros(0)
            weights = np.exp(logits - top[:, None])
            yield pd.DataFrame({"receiver": row * block + own, "n": mask[own].sum(axis=1), "top": top, "weight": weights.sum(axis=1), "total": list(weights @ v)})


def node_update(nodes: DataFrame, edges: DataFrame, key: str, feature: str, message: str) -> DataFrame:
    """Per node: its feature, the sums of the messages that it gets and that it sends."""
    got = edges.groupBy(F.col("receiver").alias(key)).agg(F.sum(message).alias("received"))
    sent = edges.groupBy(F.col("sender").alias(key)).agg(F.sum(message).alias("sent"))
    out = nodes.select(key, feature).join(got, key, "left").join(sent, key, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("received", "sent")})


def network(nodes: DataFrame, edges: DataFrame, key: str, feature: str, weight: str, rounds: int, edge_update, node_update_) -> DataFrame:
    """`rounds` of message passing: edge_update(sender's, receiver's feature, edge weight) gives the message, and
    node_update_(feature, sum of messages) the new feature, all as columns; edges (sender, receiver, weight) keep their weight."""
    state = nodes.select(F.col(key), F.col(feature).alias("_f"))
    for _ in range(rounds):  # each round is a table, else plans would triple
        at = lambda end: state.select(F.col(key).alias(end), F.col("_f").alias(f"_{end}"))
        sent = edges.select("sender", "receiver", weight).join(at("sender"), "sender").join(at("receiver"), "receiver")
        sums = sent.groupBy(F.col("receiver").alias(key)).agg(F.sum(edge_update(F.col("_sender"), F.col("_receiver"), F.col(weight))).alias("_sum"))
        state = kept(state.join(sums, key, "left").select(key, node_update_(F.col("_f"), F.coalesce("_sum", F.lit(0.0))).alias("_f")))
    return state.withColumnRenamed("_f", feature)


def global_sums(nodes: DataFrame, edges: DataFrame, graph: str, node_feature: str, edge_feature: str) -> DataFrame:
    """Per graph: the sums of its nodes' and of its edges' features, and how many there are."""
    n = nodes.groupBy(graph).agg(F.sum(node_feature).alias("node_sum"), F.count(F.lit(1)).alias("nodes"))
    e = edges.groupBy(graph).agg(F.sum(edge_feature).alias("edge_sum"), F.count(F.lit(1)).alias("edges"))
    return n.join(e, graph, "full").select(graph, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("node_sum", "nodes", "edge_sum", "edges")])


def padded_edges(edges: DataFrame, group: str, order: list[str], multiple: int, spread: bool = False) -> DataFrame:
    """Edges of each group numbered from 0 and filled up to a multiple with edges from -1 to -1, which stand at the end or
    (spread) evenly between the others: of k slots for n edges, edge i stands at the whole part of i * (k - 1) / (n - 1)."""
    numbered = edges.withColumn("slot", F.row_number().over(W.partitionBy(group).orderBy(*order)) - 1).select(group, "slot", "sender", "receiver")
    n = edges.groupBy(group).agg(F.count(F.lit(1)).cast("int").alias("n"))
    full = F.ceil(F.col("n") / multiple).cast("int") * multiple
    if spread:
        sized = numbered.join(n.withColumn("_full", full), group)
        at = F.when(F.col("n") > 1, F.expr("slot * (_full - 1) div greatest(n - 1, 1)")).otherwise(0).cast("int")
        numbered = sized.withColumn("slot", at).select(group, "slot", "sender", "receiver")
        slots = n.select(group, F.explode(F.sequence(F.lit(0), full - 1)).alias("slot"))
        out = slots.join(numbered, [group, "slot"], "left")
        return out.withColumns({c: F.coalesce(c, F.lit(-1).cast("long")) for c in ("sender", "receiver")})
    fill = n.where(full > F.col("n")).select(group, F.explode(F.sequence(F.col("n"), full - 1)).alias("slot"))
    return numbered.unionByName(fill.withColumns({"sender": F.lit(-1).cast("long"), "receiver": F.lit(-1).cast("long")}))
