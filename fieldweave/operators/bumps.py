"""Sums of bumps that reach every cell of a grid: in arrays, some places at a time, with no row for a place and cell."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_KM
from ..sources.tables import ship

#: Values of places and cells that are held at once.
HELD = 1 << 20


def _summing(radius_km: float, cell: float, keys: list[str], normalized: bool):
    bands, columns = int(180 / cell) + 1, int(360 / cell)
    cell_lat, cell_lon = np.arange(bands) * cell - 90.0, np.arange(columns) * float(cell)
    at_once = max(1, HELD // (bands * columns))

    def bumps(lat: np.ndarray, lon: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The weighted sum of the bumps of some places, by band and column."""
        lat, lon = lat[:, None], lon[:, None]
        rise = np.sin(np.radians(cell_lat - lat) / 2) ** 2
        narrow = np.cos(np.radians(lat)) * np.cos(np.radians(cell_lat))
        h = rise[:, :, None] + narrow[:, :, None] * (np.sin(np.radians(cell_lon - lon) / 2) ** 2)[:, None, :]
        g = np.exp(-0.5 * (2 * EARTH_KM / radius_km * np.arcsin(np.minimum(1.0, np.sqrt(h)))) ** 2)
        return np.tensordot(weight / g.sum(axis=(1, 2)) if normalized else weight, g, 1)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places come sorted by `_frame`, a number of their keys: a task holds one frame's cells."""
        frame, head, known, total = None, [], 0, None
        lats, lons = (x.ravel() for x in np.meshgrid(cell_lat, cell_lon, indexing="ij"))

        def out() -> pa.RecordBatch:
            columns = [*[pa.repeat(k, total.size) for k in head], pa.array(lats), pa.array(lons), pa.repeat(pa.scalar(known), total.size), pa.array(total.ravel())]
            return pa.RecordBatch.from_arrays(columns, names=[*keys, "cell_lat", "cell_lon", "_known", "_sum"])

        for batch in batches:
            lat, lon, weight, there, frames = (batch.column(c).to_numpy() for c in ("lat", "lon", "_weight", "_known", "_frame"))
            ends = [*(np.flatnonzero(np.diff(frames)) + 1).tolist(), len(frames)] if len(frames) else []
            for start, end in zip([0, *ends], ends, strict=False):
                if frames[start] != frame:
                    if frame is not None:
                        yield out()
                    frame, head, known, total = frames[start], [batch.column(k)[start] for k in keys], 0, np.zeros((bands, columns))
                known += int(there[start:end].sum())
                for at in range(start, end, at_once):
                    some = slice(at, min(at + at_once, end))
                    total += bumps(lat[some], lon[some], weight[some])
        if frame is not None:
            yield out()

    return sums


def whole_bumps(places: DataFrame, radius_km: float, cell: float, keys: list[str], normalized: bool) -> DataFrame:
    """keys, cell_lat, cell_lon, gaussian of places (keys, lat, lon, _weight), which are cut into ranges of keys: a task sends a
    row for each of its frames and cells."""
    spark = places.sparkSession
    ship(spark)
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = places.where("lat IS NOT NULL AND lon IS NOT NULL").select(*keys, F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.col("_weight").isNotNull().cast("int").alias("_known"), F.coalesce(F.col("_weight").cast("double"), F.lit(0.0)).alias("_weight"), F.xxhash64(F.lit(0), *keys).alias("_frame"))
    cut = rows.repartitionByRange(number, *keys, "_frame", "lat", "lon").sortWithinPartitions(*keys, "_frame")
    kinds = {f.name: f.dataType.simpleString() for f in places.schema}
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "cell_lat double, cell_lon double, _known long, _sum double"])
    parts = cut.mapInArrow(_summing(radius_km, cell, keys, normalized), schema)
    return parts.groupBy(*keys, "cell_lat", "cell_lon").agg(F.when(F.sum("_known") > 0, F.sum("_sum")).alias("gaussian"))
