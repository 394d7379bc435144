"""Exact top-k inner product search with cover trees of candidates and of queries.

A bounded number of vectors drawn by hash are pivots. Each row belongs to the cell of its nearest pivot; a cell is dealt into
blocks of bounded size, and each block becomes a cover tree, a row of the index. A query tree first meets one candidate tree of its
own cell, which gives each query a k-th score to beat. A cell then stays in the search of this query tree only if its pivot and
covering radius allow one of the queries a score that high; its other trees are joined with the trees of the cells that
stay. The search of two trees descends both at once: a pair of nodes is dropped if its best possible inner product, from the centres and
the two covering radii, is below the worst k-th score of the query node's group. Each pair of trees returns k rows a query at
most, and a window keeps the best of them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_table, ship_package

K, QUERY_EVERY, SCALE = 5, 50, 256
#: Rows of a candidate block and of a query block, on average; pivots at most.
CANDIDATES, QUERIES, PIVOTS = 16384, 1024, 256
_LEAF, _FAN, _BASE = 64, 16, 1.6
#: Squared lengths below this keep every score and every sum on the way to it exact in a double.
_MOST = float(1 << 52)


class Tree:
    """A cover tree over integer vectors. Points of a node are a slice of the tree's order; node 0 is the root."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.order = np.arange(len(ids))
        self.first, self.last, self.centre, self.radius, self.kids = [], [], [], [], []
        points = vectors.astype(np.float64)  # products of integers are exact below 2 ** 53
        self._grow(points, 0, len(ids), int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1))))
        self.ids, self.points = ids[self.order], points[self.order]
        if np.abs(self.points).max(initial=0) < 1 << 24:
            self.points = self.points.astype(np.float32)  # as exact, and half as large
        self.centre = points[self.centre]
        self.radius = np.array(self.radius)
        self.norm = np.sqrt((self.centre**2).sum(axis=1))

    def _grow(self, points: np.ndarray, a: int, b: int, centre: int) -> int:
        """A node over order[a:b]: centres of the next level are picked farthest first until all are within the smaller radius."""
        node = len(self.first)
        own = self.order[a:b]
        away = np.sqrt(((points[own] - points[centre]) ** 2).sum(axis=1))
        self.first.append(a), self.last.append(b), self.centre.append(centre), self.radius.append(float(away.max())), self.kids.append([])
        if b - a <= _LEAF or away.max() == 0:
            return node
        nearest, centres, at = away.copy(), [centre], np.zeros(b - a, np.int64)
        while nearest.max() > away.max() / _BASE and len(centres) < _FAN:
            far = int(nearest.argmax())
            d = np.sqrt(((points[own] - points[own[far]]) ** 2).sum(axis=1))
            closer = d < nearest
            nearest[closer], at[closer] = d[closer], len(centres)
            centres.append(int(own[far]))
        sort = np.argsort(at, kind="stable")
        self.order[a:b] = own[sort]
        edges = a + np.searchsorted(at[sort], np.arange(len(centres) + 1))
        self.kids[node] = [self._grow(points, int(x), int(y), c) for c, x, y in zip(centres, edges, edges[1:], strict=False) if y > x]
        return node

    def children(self, node: int) -> list[int]:
        return self.kids[node] or [node]


def search(queries: Tree, candidates: Tree, k: int = K, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """[queries, k] ids and scores, best first, ties to smaller ids; missing ones have score -inf. Rows go as queries.ids.

    floor: a score for each query, below which nothing is looked for."""
    n = len(queries.ids)
    scores, ids = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
    worst = np.full(n, -np.inf) if floor is None else floor.copy()
    stack = [(np.inf, 0, 0)]
    while stack:
        best, q, c = stack.pop()
        rows = slice(queries.first[q], queries.last[q])
        if best < worst[rows].min():
            continue
        if not queries.kids[q] and not candidates.kids[c]:
            cols = slice(candidates.first[c], candidates.last[c])
            found = queries.points[rows].astype(np.float64) @ candidates.points[cols].T.astype(np.float64)
            found[queries.ids[rows][:, None] == candidates.ids[cols][None, :]] = -np.inf
            better = np.flatnonzero((found >= worst[rows, None]).any(axis=1))
            if len(better):
                at = queries.first[q] + better
                s = np.concatenate([scores[at], found[better]], axis=1)
                i = np.concatenate([ids[at], np.broadcast_to(candidates.ids[cols], (len(at), cols.stop - cols.start))], axis=1)
                i = np.where(np.isneginf(s), np.iinfo(np.int64).max, i)
                top = np.lexsort((i, -s), axis=1)[:, :k]
                scores[at], ids[at] = np.take_along_axis(s, top, axis=1), np.take_along_axis(i, top, axis=1)
                worst[at] = np.maximum(worst[at], scores[at, -1])
            continue
        # The wider node is opened.
        if queries.kids[q] and (not candidates.kids[c] or queries.radius[q] > candidates.radius[c]):
            qs, cs = queries.kids[q], [c]
        else:
            qs, cs = [q], candidates.kids[c]
        bound = queries.centre[qs] @ candidates.centre[cs].T
        bound += queries.norm[qs][:, None] * candidates.radius[cs] + queries.radius[qs][:, None] * (candidates.norm[cs] + candidates.radius[cs])
        bound += 1e-6 * (1 + np.abs(bound))  # radii are rounded, scores are not
        pairs = [(bound[i, j], x, y) for i, x in enumerate(qs) for j, y in enumerate(cs)]
        stack.extend(sorted(pairs))  # the most promising pair is opened first
    return ids, scores


def _grow(pdf: pd.DataFrame) -> pd.DataFrame:
    vectors = np.array(pdf["v"].tolist(), np.int64)
    return pd.DataFrame({"dim": [int(pdf["dim"].iloc[0])], "cell": [int(pdf["cell"].iloc[0])], "part": [int(pdf["part"].iloc[0])], "tree": [pickle.dumps(Tree(pdf["vec_id"].to_numpy(), vectors))]})


def index(rows: DataFrame, block_rows: int) -> DataFrame:
    """dim, cell, part, tree: rows (vec_id, v array<long>, dim, cell, place) of each cell, dealt into blocks by place."""
    parts = rows.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts"))
    dealt = rows.join(parts, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "place"), F.col("parts")))
    return dealt.select("dim", "cell", "part", "vec_id", "v").groupBy("dim", "cell", "part").applyInPandas(lambda pdf: _grow(pdf), "dim int, cell int, part long, tree binary")


def celled(rows: DataFrame, block_rows: int, most_pivots: int) -> tuple[DataFrame, list[np.ndarray]]:
    """Rows with the number of their nearest pivot of the same length (cell; -1 if there is none) and the distance (away), and the pivots.

    There is a pivot for every block_rows rows, most_pivots at most: the rows with the smallest hashes, each vector once."""
    n = min(most_pivots, max(1, -(-rows.count() // block_rows)))
    drawn = F.xxhash64(F.lit("pivot"), "v")
    least = [r[0] for r in rows.select(drawn.alias("h")).distinct().orderBy("h").limit(n).collect()]  # hashes alone are shuffled
    drawn = rows.where(drawn.isin(least)).groupBy(drawn.alias("h")).agg(F.min("v").alias("v")).orderBy("h").collect()
    pivots = [np.array(r["v"], np.float64) for r in drawn]
    of = {d: [i for i, p in enumerate(pivots) if len(p) == d] for d in {len(p) for p in pivots}}

    @F.pandas_udf("cell int, away double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        cell, away = np.full(len(vectors), -1), np.zeros(len(vectors))
        length = vectors.map(len).to_numpy()
        for d in set(length.tolist()) & of.keys():
            at = np.flatnonzero(length == d)
            x = np.stack(vectors.iloc[at].to_list()).astype(np.float64)
            squares = np.stack([((x - pivots[i]) ** 2).sum(axis=1) for i in of[d]], axis=1)
            cell[at], away[at] = np.array(of[d])[squares.argmin(axis=1)], np.sqrt(squares.min(axis=1))
        return pd.DataFrame({"cell": cell, "away": away})

    found = rows.select("*", nearest.asNondeterministic()("v").alias("found"))
    return found.select("vec_id", "v", "dim", "place", "found.cell", "found.away"), pivots


def _rows(queries: Tree, ids: np.ndarray, scores: np.ndarray, names: tuple) -> pd.DataFrame:
    row, col = np.nonzero(~np.isneginf(scores))
    cell, part = names
    return pd.DataFrame({"query_id": queries.ids[row], "q_cell": np.full(len(row), cell), "q_part": np.full(len(row), part), "q_row": row, "vec_id": ids[row, col], "score": scores[row, col].astype(np.int64)})


def _first(batches: Iterator[pd.DataFrame], k: int, pivots: list[np.ndarray], radii: dict[int, float]) -> Iterator[pd.DataFrame]:
    """Searches a tree of the queries' own cell, if there is one; floor holds the k-th scores, cells the cells that may still matter."""
    for pdf in batches:
        for dim, cell, part, q, c in zip(pdf["dim"], pdf["q_cell"], pdf["q_part"], pdf["q_tree"], pdf["c_tree"], strict=True):
            queries = pickle.loads(q)
            floor = search(queries, pickle.loads(c), k)[1][:, -1] if c is not None else np.full(len(queries.ids), -np.inf)
            x, cells = queries.points.astype(np.float64), [-1]
            norm = np.sqrt((x**2).sum(axis=1))
            for i, r in radii.items():
                if len(pivots[i]) == dim:
                    best = x @ pivots[i] + norm * r
                    if (best + 1e-6 * (1 + np.abs(best)) >= floor).any():
                        cells.append(i)
            yield pd.DataFrame({"dim": [dim], "q_cell": [cell], "q_part": [part], "q_tree": [q], "floor": [floor.tolist()], "cells": [cells]})


def _search(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for cell, part, q, floor, c in zip(pdf["q_cell"], pdf["q_part"], pdf["q_tree"], pdf["floor"], pdf["c_tree"], strict=True):
            queries, floor = pickle.loads(q), np.array(floor, np.float64)
            ids, scores = search(queries, pickle.loads(c), k, floor)
            yield _rows(queries, ids, np.where(scores >= floor[:, None], scores, -np.inf), (cell, part))


def quantized(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (floor(SCALE * x) of each component), dim, squares (the squared length of v) and place, a number of the row; a row a usable row."""
    x = F.col(vector)
    usable = x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))) & F.col(vec_id).isNotNull() & (F.size(x) > 0)
    scaled = F.transform(x, lambda e: e.cast("double") * SCALE)
    rows = embeddings.where(usable).select(F.col(vec_id).cast("long").alias("vec_id"), scaled.alias("x"), F.size(x).alias("dim"))
    # A component too large for a long is caught by its squared length.
    v = F.transform("x", lambda e: F.floor(F.greatest(F.lit(-_MOST), F.least(F.lit(_MOST), e))))
    return rows.select("vec_id", v.alias("v"), "dim", F.aggregate("x", F.lit(0.0), lambda s, e: s + e * e).alias("squares"), F.monotonically_increasing_id().alias("place"))


def top_k(embeddings: DataFrame, k: int = K, query_every: int = QUERY_EVERY, candidate_rows: int = CANDIDATES, query_rows: int = QUERIES, most_pivots: int = PIVOTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each row whose id is divisible by query_every.

    Ids are whole numbers. Ties go to the smaller vec_id. Vectors that are null or empty or hold null or non-finite components take no part, nor
    do null ids; queries meet vectors of their own length, however long. Rows that repeat an id are all candidates, for
    all queries but those of this id; rows that repeat a query's id are queries of their own if their vectors differ, and
    one query if they do not. Scores are exact: a vector whose squared length, times SCALE squared, reaches 2 ** 52 is a
    ValueError. A query alone of its length has no row; an empty table gives an empty result; other columns are ignored."""
    ship_package(embeddings.sparkSession)
    rows = as_table(quantized(embeddings, vec_id, vector), "vectors")
    n, most = rows.agg(F.count(F.lit(1)), F.coalesce(F.max("squares"), F.lit(0.0))).first()
    if most >= _MOST:
        raise ValueError(f"a vector of squared length {most:g} (in units of 1 / {SCALE}) has no exact scores; they must lie below 2 ** 52")
    found, pivots = celled(rows.drop("squares"), candidate_rows, most_pivots)
    rows = as_table(found, "cells")
    asking = rows.where(F.col("vec_id") % query_every == 0).dropDuplicates(["vec_id", "v"])
    radii = {r["cell"]: r["r"] for r in rows.where("cell >= 0").groupBy("cell").agg(F.max("away").alias("r")).collect()}  # most_pivots rows at most
    candidates = as_table(index(rows, candidate_rows), "candidate_trees").withColumnRenamed("tree", "c_tree")
    queries = index(asking, query_rows).select("dim", F.col("cell").alias("q_cell"), F.col("part").alias("q_part"), F.col("tree").alias("q_tree"))
    own = candidates.where("part = 0").select("dim", F.col("cell").alias("q_cell"), "c_tree")
    floors = "dim int, q_cell int, q_part long, q_tree binary, floor array<double>, cells array<int>"
    first = as_table(queries.join(own, ["dim", "q_cell"], "left").mapInPandas(lambda batches: _first(batches, k, pivots, radii), floors), "floors")
    pairs = first.withColumn("cell", F.explode("cells")).drop("cells").join(candidates, ["dim", "cell"])
    out = pairs.select("q_cell", "q_part", "q_tree", "floor", "c_tree").mapInPandas(lambda batches: _search(batches, k), "query_id long, q_cell int, q_part long, q_row long, vec_id long, score long")
    best = W.partitionBy("query_id", "q_cell", "q_part", "q_row").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
