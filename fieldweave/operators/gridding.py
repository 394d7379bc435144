"""Best-track fixes on grids: existence, scalars, categories and quadrants, for all frames and sources in the same jobs.

Results are long: (keys, variable, cell_lat, cell_lon, value). `keys` name the frame (a step, a time) and, if wanted, the
source of the positions. Cells without a row are background: 0 for existence and categories, NaN for the rest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cyclones import disc_values, gaussian_raster, impute
from .spheres import disc_cells, quadrant_raster

#: The names of the quadrants in order, and what is added to a category so that none is below 0.
QUADRANT_NAMES, CATEGORY_SHIFT = ("ne", "se", "sw", "nw"), 6



def _nan() -> Column:
    return F.lit(float("nan"))


def nearest(cell: float) -> tuple[Column, Column]:
    """The cell of a grid nearest to (lat, lon)."""
    return (F.round((F.col("lat") + 90) / cell) * cell - 90).alias("cell_lat"), (F.round(F.col("lon") / cell) * cell % 360).alias("cell_lon")


def _as(rows: DataFrame, keys: list[str], variable: Column | str, value: Column | str) -> DataFrame:
    name = F.lit(variable) if isinstance(variable, str) else variable
    return rows.select(*keys, name.alias("variable"), "cell_lat", "cell_lon", (F.col(value) if isinstance(value, str) else value).cast("double").alias("value"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def existence(fixes: DataFrame, keys: list[str], radius_km: float, cell: float, core: bool = True, parts: int = 4, most_error: float = 0.0) -> DataFrame:
    """Gaussian bumps around the fixes; beyond the core also the cells nearest to them, discs by shares of cells, and bumps
    that each sum to 1. Fixes without a position are left out."""
    known = fixes.where(~F.isnan(F.coalesce("lat", _nan())) & ~F.isnan(F.coalesce("lon", _nan())))
    bumps = lambda normalized: gaussian_raster(known, radius_km, cell, keys=tuple(keys), normalized=normalized, most_error=most_error)
    out = [_as(bumps(False), keys, "exists_gaussian_unit_mode", "gaussian")]
    if not core:
        round_ones = known.withColumn("_radii", F.array(*[F.lit(float(radius_km))] * 4))
        out += [
            _as(known.select(*keys, *nearest(cell)).distinct().withColumn("value", F.lit(1.0)), keys, "exists_sparse", "value"),
            _as(quadrant_raster(round_ones, "_radii", F.lit(1), cell, parts, tuple(keys)), keys, "exists_disc", "covered"),
            _as(bumps(True), keys, "exists_gaussian_probability", "gaussian"),
        ]
    return _union(out)


def _rasters(rows: DataFrame, keys: list[str], order: str, radius_km: float, cell: float, core: bool) -> DataFrame:
    """Discs of rows (keys, lat, lon, order, variable, value), NaN where one of them has NaN; beyond the core also the
    cell nearest to each row, which the last row in `order` sets."""
    both = [*keys, "variable"]
    discs = disc_values(rows, "value", radius_km, cell, tuple(both))
    out = [_as(discs, keys, F.concat("variable", F.lit("_disc")), F.when(F.col("has_nan"), _nan()).otherwise(F.col("value")))]
    if not core:
        last = rows.groupBy(*both, *nearest(cell)).agg(F.max_by("value", order).alias("value"))
        out.append(_as(last, keys, F.concat("variable", F.lit("_sparse")), "value"))
    return _union(out)


def _long(fixes: DataFrame, keys: list[str], order: str, values: dict[str, Column]) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("variable"), F.coalesce(v.cast("double"), _nan()).alias("value")) for n, v in values.items()]))
    return fixes.select(*keys, order, "lat", "lon", pairs.alias("_p")).select(*keys, order, "lat", "lon", "_p.*")


def scalars(fixes: DataFrame, keys: list[str], order: str, names: list[str], radius_km: float, cell: float, core: bool = True) -> DataFrame:
    """Winds, radii and pressures: per variable the greatest value of the discs that hold a cell, 0 at least."""
    return _rasters(_long(fixes, keys, order, {n: F.col(n) for n in names}), keys, order, radius_km, cell, core)


def missing(fixes: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Per frame, which of the variables have a fix without value: has_<name>_nan."""
    return fixes.groupBy(*keys).agg(*[F.bool_or(F.col(n).isNull() | F.isnan(n)).alias(f"{n}_has_nan") for n in names])


def categories(fixes: DataFrame, keys: list[str], order: str, category: str, radius_km: float, cell: float) -> DataFrame:
    """Discs and nearest cells of a category, shifted to be above 0: the background is 0."""
    return _rasters(_long(fixes, keys, order, {category: F.col(category) + CATEGORY_SHIFT}), keys, order, radius_km, cell, False)


def quadrants(fixes: DataFrame, keys: list[str], order: str, sources: dict[str, tuple[str, str, float]], radius_km: float, nan_km: float, cell: float, core: bool = True, parts: int = 4) -> DataFrame:
    """sources: name to (column of four radii, column of the wind, threshold). Per quadrant discs of the radius, imputed where
    unknown; beyond the core also the shapes by shares of cells, NaN near fixes without any radius and too little wind."""
    out = []
    for name, (radii, wind, threshold) in sources.items():
        known = F.coalesce(F.nanvl(wind, F.lit(0.0)), F.lit(0.0))
        filled, flag = impute([F.col(radii).getItem(i) for i in range(4)], known, threshold)
        rows = fixes.withColumns({"_radii": F.array(*filled), "_flag": flag})
        values = {f"{name}_{q}_radius": F.col("_radii").getItem(i) for i, q in enumerate(QUADRANT_NAMES)}
        out.append(_rasters(_long(rows, keys, order, values), keys, order, radius_km, cell, core))
        if not core:
            shape = quadrant_raster(rows, "_radii", F.lit(1), cell, parts, tuple(keys))
            dark = disc_cells(rows.where("_flag = 'missing'").select(*keys, "lat", "lon"), F.lit(nan_km), cell)
            dark = dark.select(*keys, "cell_lat", "cell_lon").distinct().withColumn("_dark", F.lit(True))
            met = shape.join(dark, [*keys, "cell_lat", "cell_lon"], "full")
            out.append(_as(met, keys, f"{name}_shape", F.when(F.col("_dark"), _nan()).otherwise(F.col("covered"))))
    return _union(out)


def gridded(fixes: DataFrame, first: int, last: int, cell: float, radius_km: float, scalar_names: list[str], scalar_km: float, category: str, sources: dict[str, tuple[str, str, float]], nan_km: float, core: bool = True, prefix: str = "cyclone_", most_error: float = 0.0) -> DataFrame:
    """All families for the steps from first to last: (step, variable, cell_lat, cell_lon, value), names prefixed."""
    rows, keys = fixes.where(F.col("step").between(first, last)), ["step"]
    parts = [
        existence(rows, keys, radius_km, cell, core, most_error=most_error),
        scalars(rows, keys, "track_id", scalar_names, scalar_km, cell, core),
        quadrants(rows, keys, "track_id", sources, scalar_km, nan_km, cell, core),
    ]
    if not core:
        parts.append(categories(rows, keys, "track_id", category, scalar_km, cell))
    return _union(parts).withColumn("variable", F.concat(F.lit(prefix), F.col("variable")))
