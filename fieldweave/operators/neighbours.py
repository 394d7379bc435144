"""How many places lie near each place of a frame, and the greatest value among them, without a row for each pair.

Rows at one place are one place with a count. Places meet in blocks of space. In a block they lie in small cells, and
cells are compared with cells: one that lies within the reach of all of another's places counts as a whole, and only
the places of cells at the rim of the reach are looked at one by one."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_KM
from ..sources.tables import ship
from .spheres import chord, cube, reached_cubes

#: Places of a cell on average, and distances that are held at once.
CELL_PLACES, HELD = 16, 1 << 21


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)], axis=1)


def _km(lat0, lon0, lat1, lon1):
    h = np.sin(np.radians(lat1 - lat0) / 2) ** 2 + np.cos(np.radians(lat0)) * np.cos(np.radians(lat1)) * np.sin(np.radians(lon1 - lon0) / 2) ** 2
    return 2 * EARTH_KM * np.arcsin(np.minimum(1.0, np.sqrt(h)))


def _counting(keys: list[str], radius_km: float):
    reach, level = chord(radius_km), np.cos(min(radius_km / EARTH_KM, np.pi))

    def counts(block: pd.DataFrame) -> pd.DataFrame:
        side = min(max(3 * reach * np.sqrt(CELL_PLACES / len(block)), reach / 512), max(reach / 2, 1e-6))
        at = np.floor((_unit(block["lat"].to_numpy(), block["lon"].to_numpy()) + 1) / side).astype(np.int64)
        _, cell = np.unique((at[:, 0] << 42) + (at[:, 1] << 21) + at[:, 2], return_inverse=True)
        order = np.argsort(cell, kind="stable")
        block, sizes = block.iloc[order], np.bincount(cell)
        lat, lon, own = (block[c].to_numpy() for c in ("lat", "lon", "_own"))
        places, weights, top = _unit(lat, lon), block[["_n", "_known"]].to_numpy(float), block["_top"].to_numpy()
        ends = np.cumsum(sizes)
        starts = ends - sizes
        middle = np.add.reduceat(places, starts) / sizes[:, None]
        extent = np.maximum.reduceat(np.linalg.norm(places - np.repeat(middle, sizes, axis=0), axis=1), starts)
        all_weights, all_top = np.add.reduceat(weights, starts), np.maximum.reduceat(top, starts)
        near_weights, near_top = np.zeros_like(weights), np.full(len(top), -np.inf)
        for g in np.flatnonzero(np.add.reduceat(own.astype(int), starts)):
            apart, slack = np.linalg.norm(middle - middle[g], axis=1), extent + extent[g]
            inside = apart + slack < reach - 1e-9
            rim = np.flatnonzero(np.repeat(~inside & (apart - slack <= reach + 1e-9), sizes))
            whole, most = all_weights[inside].sum(axis=0), all_top[inside].max(initial=-np.inf)
            mine = starts[g] + np.flatnonzero(own[starts[g] : ends[g]])
            for some in np.array_split(mine, len(mine) * len(rim) // HELD + 1):
                cosine = places[some] @ places[rim].T
                near = cosine > level
                i, j = np.nonzero(np.abs(cosine - level) < 1e-12)  # too close to call by cosines
                near[i, j] = _km(lat[some[i]], lon[some[i]], lat[rim[j]], lon[rim[j]]) < radius_km
                near_weights[some] = whole + near.astype(float) @ weights[rim]
                near_top[some] = np.maximum(most, np.where(near, top[rim], -np.inf).max(axis=1, initial=-np.inf))
        found = {"near": near_weights[:, 0].astype(np.int64), "known": near_weights[:, 1].astype(np.int64), "top": near_top}
        return block[[*keys, "lat", "lon"]].assign(**found)[own]

    return counts


def near_counts(rows: DataFrame, keys: list[str], value: str, radius_km: float) -> DataFrame:
    """keys, lat, lon of each place, and of the rows with equal keys that lie nearer than radius_km, its own among them: their
    number (near), how many of them have the value (known), and the greatest (top). Rows without a position are left out."""
    ship(rows.sparkSession)
    there = ~F.isnan(F.coalesce("lat", F.lit(float("nan")))) & ~F.isnan(F.coalesce("lon", F.lit(float("nan"))))
    counts = {"_n": F.count(F.lit(1)), "_known": F.count(value), "_top": F.coalesce(F.max(F.col(value).cast("double")), F.lit(float("-inf")))}
    places = rows.where(there).groupBy(*keys, F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).agg(*[c.alias(n) for n, c in counts.items()])
    side = max(2 * chord(radius_km), 0.25)
    own = cube(F.col("lat"), F.col("lon"), side)
    cubes = list(own)
    is_own = F.lit(True)
    for name, c in own.items():
        is_own = is_own & (F.col(name) == c)
    sent = reached_cubes(places, side, radius_km).withColumn("_own", is_own)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "lat double, lon double, near long, known long, top double"])
    found = sent.groupBy(*keys, *cubes).applyInPandas(_counting(keys, radius_km), schema)
    return found.withColumn("top", F.coalesce("top", F.lit(float("nan"))))  # pandas has no NaN of its own
