"""Positions on the sphere in the frames of others, discs of grids, quadrants, reads between grid points."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import EARTH_KM, cartesian, distance_km, is_east, latlon
from ..sources.tables import dealt

#: The length of a degree at the equator and of a meridian from pole to pole, in km.
DEGREE_KM, MERIDIAN_KM = 111.3, 20004.0


def local_position(lat: Column, lon: Column, at_lat: Column, at_lon: Column, turn_lat: bool = True, turn_lon: bool = True) -> tuple[Column, Column, Column]:
    """The position of (lat, lon) relative to (at_lat, at_lon), in axes turned so that the latter lies at longitude 0
    (turn_lon), at latitude 0 (turn_lat), or both. Without either, the plain difference."""
    a, b = F.radians(at_lat), F.radians(at_lon)

    def turned(p: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
        x, y, z = p
        if not (turn_lat or turn_lon):
            return p
        x, y = F.cos(b) * x + F.sin(b) * y, F.cos(b) * y - F.sin(b) * x
        if turn_lat:
            x, z = F.cos(a) * x + F.sin(a) * z, F.cos(a) * z - F.sin(a) * x
        if not turn_lon:
            x, y = F.cos(b) * x - F.sin(b) * y, F.sin(b) * x + F.cos(b) * y
        return x, y, z

    here, there = turned(cartesian(lat, lon)), turned(cartesian(at_lat, at_lon))
    return here[0] - there[0], here[1] - there[1], here[2] - there[2]


def edge_features(edges: DataFrame, scale: float | None = None) -> DataFrame:
    """Length and relative position (dx, dy, dz) of the sender in the receiver's frame, as shares of the longest edge.

    edges: s_lat, s_lon, r_lat, r_lon. The longest edge is one number, found in a pass of its own unless it is given."""
    dx, dy, dz = local_position(F.col("s_lat"), F.col("s_lon"), F.col("r_lat"), F.col("r_lon"))
    out = edges.withColumns({"dx": dx, "dy": dy, "dz": dz}).withColumn("length", F.sqrt(F.col("dx") ** 2 + F.col("dy") ** 2 + F.col("dz") ** 2))
    if scale is None:
        out = out.join(F.broadcast(out.agg(F.max("length").alias("_longest"))))  # one row
    else:
        out = out.withColumn("_longest", F.lit(scale))
    share = lambda c: F.when(F.col("_longest") > 0, F.col(c) / F.col("_longest")).otherwise(0.0)
    return out.withColumns({c: share(c) for c in ("dx", "dy", "dz", "length")}).drop("_longest")


def box_sides(lat: Column, radius_km: Column) -> tuple[Column, Column]:
    """Sides in degrees of a box that holds the disc: the longitude's is stretched by the disc's extreme latitudes, 360 at most."""
    side, half = radius_km * 2 / DEGREE_KM, radius_km / MERIDIAN_KM * 180
    narrow = F.least(F.cos(F.radians(F.least(F.lit(90.0), lat + half))), F.cos(F.radians(F.greatest(F.lit(-90.0), lat - half))))
    return side, F.when(narrow <= 0, 360.0).otherwise(F.least(side / narrow, F.lit(360.0)))


def quadrant(lat: Column, lon: Column, centre_lat: Column, centre_lon: Column) -> Column:
    """1 to 4 for NE, SE, SW, NW of the centre; the meridian and the parallel of the centre count as east and north."""
    north, east = lat >= centre_lat, is_east(lon, centre_lon)
    return F.when(east & north, 1).when(east, 2).when(~north, 3).otherwise(4)


def in_quadrants(lat: Column, lon: Column, centre_lat: Column, centre_lon: Column, radii: Column, margin_km: float = 0.0) -> Column:
    """Whether a place is nearer to the centre than the radius (NE, SE, SW, NW) of the quadrant that it lies in, and a margin.
    A place at just that distance is outside, and so is all of a quadrant whose radius is unknown."""
    reach = F.element_at(radii, quadrant(lat, lon, centre_lat, centre_lon))
    return F.coalesce((distance_km(centre_lat, centre_lon, lat, lon) < reach + margin_km) & ~F.isnan(reach), F.lit(False))


def cube(lat: Column, lon: Column, side: float) -> dict[str, Column]:
    """The cube of space that a place of the unit sphere lies in, as columns _cx, _cy, _cz."""
    return {f"_c{n}": F.floor(c / side).cast("long") for n, c in zip("xyz", cartesian(lat, lon), strict=True)}


def chord(km: float) -> float:
    """The straight distance on the unit sphere of places that far apart."""
    return 2 * math.sin(min(km / EARTH_KM, math.pi) / 2)


def reached_cubes(rows: DataFrame, side: float, km: float) -> DataFrame:
    """rows (lat, lon), once for each cube of that side that holds places of the sphere no farther than km. Cubes of several
    times that reach leave few copies of a row; rows without a position reach none."""
    most = chord(km) + 1e-9
    out = rows.withColumns({f"_{n}": c for n, c in zip("xyz", cartesian(F.col("lat"), F.col("lon")), strict=True)})
    for n in "xyz":
        out = out.withColumn(f"_c{n}", F.explode(F.sequence(*[F.floor((F.col(f"_{n}") + d) / side).cast("long") for d in (-most, most)])))
    low, zero = lambda n: F.col(f"_c{n}") * side, F.lit(0.0)
    total = lambda part: sum((part(n) * part(n) for n in "xyz"), zero)
    gap = total(lambda n: F.greatest(zero, low(n) - F.col(f"_{n}"), F.col(f"_{n}") - low(n) - side))
    nearest, farthest = total(lambda n: F.greatest(zero, low(n), -low(n) - side)), total(lambda n: F.greatest(F.abs(low(n)), F.abs(low(n) + side)))
    return out.where((gap <= most * most) & (nearest <= 1 + 1e-9) & (farthest >= 1 - 1e-9)).drop("_x", "_y", "_z")


def grid_cells(spark: SparkSession, cell: float) -> DataFrame:
    """(cell_lat, cell_lon) of the whole grid of `cell` degrees, poles and longitude 0 on it; made where it is used."""
    bands, columns = int(180 / cell) + 1, int(360 / cell)
    return spark.range(bands * columns).select((F.expr(f"id div {columns}") * float(cell) - 90.0).alias("cell_lat"), (F.col("id") % columns * float(cell)).alias("cell_lon"))


#: From a place to the one opposite, on the sphere.
HALF_ROUND_KM = math.pi * EARTH_KM


def _spread(points: DataFrame, radius: Column, cell: float) -> DataFrame:
    """A row for each cell (_band, _column) of a whole grid whose centre may lie in the point's disc: the bands that it
    touches, and in each band as many columns as the disc is wide there. A null radius touches nothing."""
    bands, columns = int(180 / cell), int(360 / cell)
    own = F.round((F.col("lat") + 90) / cell).cast("long")
    rows = dealt(points).withColumn("_radius", radius.cast("double")).where("_radius > 0")
    reach = (F.degrees(F.least("_radius", F.lit(HALF_ROUND_KM)) / EARTH_KM) / cell).cast("long") + 1
    rows = rows.withColumn("_band", F.explode(F.sequence(F.greatest(F.lit(0), own - reach), F.least(F.lit(bands), own + reach))))
    a, b = F.radians("lat"), F.radians(F.col("_band") * cell - 90)
    both = F.cos(a) * F.cos(b)
    # The cosine of half the disc's width in this band; above 1 the disc does not touch it, below -1 it holds the whole band.
    width = F.when(F.abs(both) < 1e-9, F.lit(-2.0)).otherwise((F.cos(F.least(F.col("_radius") / EARTH_KM, F.lit(math.pi))) - F.sin(a) * F.sin(b)) / both)
    rows = rows.withColumn("_width", width).where("_width <= 1.000001")
    half = F.ceil(F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("_width"))))) / cell).cast("long") + 1
    at = F.round(F.col("lon") / cell).cast("long")
    every = (F.col("_width") <= -1) | (2 * half + 1 >= columns)
    list_of = F.when(every, F.sequence(F.lit(0).cast("long"), F.lit(columns - 1).cast("long"))).otherwise(F.sequence(at - half, at + half))
    return rows.withColumn("_column", F.explode(list_of)).withColumn("_column", F.pmod("_column", F.lit(columns))).drop("_width")


def disc_cells(points: DataFrame, radius: Column, cell: float) -> DataFrame:
    """points (lat, lon) with each cell of the whole grid of `cell` degrees whose distance `d` is below the row's radius:
    cells are made, not joined, so no row moves."""
    at = {"cell_lat": F.col("_band") * cell - 90.0, "cell_lon": F.col("_column") * float(cell)}
    rows = _spread(points, radius, cell).withColumns(at)
    d = distance_km(F.col("lat"), F.col("lon"), F.col("cell_lat"), F.col("cell_lon"))
    # A radius of half the globe means every cell, its opposite among them.
    return rows.withColumn("d", d).where((F.col("d") < F.col("_radius")) | (F.col("_radius") >= HALF_ROUND_KM)).drop("_band", "_column", "_radius")


def near_cells(points: DataFrame, grid: DataFrame, radius: Column, cell: float, on: tuple[str, ...] = ()) -> DataFrame:
    """points x cells of a grid table whose distance `d` is below the row's radius.

    points: lat, lon; grid: cell_lat, cell_lon, multiples of `cell` degrees from the south pole and longitude 0; both have
    the columns `on`, which must agree. Rows meet by band and column of the cells that the disc can touch."""
    band, column = F.round((F.col("cell_lat") + 90) / cell).cast("long"), F.pmod(F.round(F.col("cell_lon") / cell).cast("long"), F.lit(int(360 / cell)))
    sent = _spread(points, radius, cell)
    met = sent.join(grid.withColumns({"_band": band, "_column": column}), [*on, "_band", "_column"]).drop("_band", "_column")
    return met.withColumn("d", distance_km(F.col("lat"), F.col("lon"), F.col("cell_lat"), F.col("cell_lon"))).where(F.col("d") < F.col("_radius")).drop("_radius")


def disc_statistics(points: DataFrame, grid: DataFrame, keys: list[str], radius_km: float, cell: float, scalars: list[str], on: tuple[str, ...] = ()) -> DataFrame:
    """Of each point's disc on a grid (cell_lat, cell_lon, p, scalars): the mean position weighted by p on the sphere, the
    cell of greatest p (ties to the first in lat, lon order), the sum of p, and the scalars' means weighted by p."""
    near = near_cells(points, grid, F.lit(radius_km), cell, on)
    xyz = cartesian(F.col("cell_lat"), F.col("cell_lon"))
    sums = near.groupBy(*keys).agg(
        *[F.sum(c * F.col("p")).alias(f"_{n}") for n, c in zip("xyz", xyz, strict=True)],
        F.max(F.struct(F.col("p"), (-F.col("cell_lat")).alias("a"), (-F.col("cell_lon")).alias("b"))).alias("_mode"),
        F.sum("p").alias("p_sum"), F.count(F.lit(1)).alias("cells"),
        *[(F.sum(F.col("p") * F.col(s)) / F.sum("p")).alias(f"mean_{s}") for s in scalars],
    )
    norm = F.sqrt(F.col("_x") ** 2 + F.col("_y") ** 2 + F.col("_z") ** 2)
    lat, lon = latlon(*[F.col(f"_{c}") / norm for c in "xyz"])
    return sums.withColumns({"mean_lat": lat, "mean_lon": lon, "mode_lat": -F.col("_mode.a"), "mode_lon": -F.col("_mode.b")}).drop("_x", "_y", "_z", "_mode")


def quadrant_raster(points: DataFrame, radii: str, value: Column, cell: float, parts: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """By keys, on a grid of `cell` degrees: the sum over points of value times the share of the cell's parts x parts sub-points that
    lie in the point's quadrant shape. Cells that no shape touches are absent; a point reaches as far as its largest radius."""
    half = lambda c: (c + 0.5) / parts - 0.5
    own = F.round((F.col("lat") + 90) / cell).cast("long")
    # Distances are compared as squared chords, whose limits are known before a point is spread.
    limit = F.transform(radii, lambda r: 4 * F.pow(F.sin(F.least(F.coalesce(r, F.lit(0.0)) / EARTH_KM, F.lit(math.pi)) / 2), 2))
    most = F.least(F.array_max(radii), F.lit(HALF_ROUND_KM))
    rows = points.select(*keys, "lat", "lon", value.alias("_value"), limit.alias("_limit"), most.alias("_most"), *[c.alias(f"_{n}") for n, c in zip("xyz", cartesian(F.col("lat"), F.col("lon")), strict=True)])
    reach = (F.col("_most") / DEGREE_KM / cell).cast("long") + 2
    rows = dealt(rows).where("_most > 0").withColumn("_band", F.explode(F.sequence(F.greatest(F.lit(0), own - reach), F.least(F.lit(int(180 / cell)), own + reach))))
    # The columns that a shape can touch in this band; near the poles all of them.
    _, side = box_sides((F.col("_band") * cell - 90), F.col("_most"))
    wide = F.least(F.ceil(side / 2 / cell).cast("long") + 1, F.lit(int(180 / cell) - 1))
    column = F.round(F.col("lon") / cell).cast("long")
    rows = rows.withColumn("_column", F.explode(F.when(wide >= int(180 / cell) - 1, F.sequence(F.lit(0).cast("long"), F.lit(int(360 / cell) - 1).cast("long"))).otherwise(F.sequence(column - wide, column + wide))))
    rows = rows.withColumns({"cell_lat": F.col("_band") * cell - 90, "cell_lon": F.pmod(F.col("_column") * cell, F.lit(360.0))})
    subs = rows.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts * parts - 1))))
    i, j = F.expr(f"_part div {parts}"), F.col("_part") % parts
    subs = subs.withColumns({"_lat": F.greatest(F.lit(-90.0), F.least(F.lit(90.0), F.col("cell_lat") + half(i) * cell)), "_lon": F.pmod(F.col("cell_lon") + half(j) * cell, F.lit(360.0))})
    chord = sum((F.pow(c - F.col(f"_{n}"), 2) for n, c in zip("xyz", cartesian(F.col("_lat"), F.col("_lon")), strict=True)), F.lit(0.0))
    inside = chord < F.element_at("_limit", quadrant(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon")))
    # Summed where inside, not filtered: an aggregate evaluates what its terms share once.
    sums = subs.select(*keys, "cell_lat", "cell_lon", F.when(inside, F.col("_value")).alias("_hit")).groupBy(*keys, "cell_lat", "cell_lon").agg(F.sum("_hit").alias("_sum"))
    return sums.where("_sum is not null").select(*keys, "cell_lat", "cell_lon", (F.col("_sum") / (parts * parts)).alias("covered"))


def bilinear(points: DataFrame, grid: DataFrame, keys: list[str], cell: float, values: list[str]) -> DataFrame:
    """Values of a grid (cell_lat, cell_lon, values) between its points; longitude wraps. Null if a corner with weight is
    missing or null, NaN if one is NaN."""
    row, column = (F.col("lat") + 90) / cell, F.pmod("lon", F.lit(360.0)) / cell
    low, left = F.least(F.floor(row), F.lit(int(180 / cell) - 1)), F.floor(column)
    corners = F.array(*[F.struct((low + i).alias("r"), ((left + j) % int(360 / cell)).alias("c"), ((row - low if i else 1 - row + low) * (column - left if j else 1 - column + left)).alias("w")) for i in (0, 1) for j in (0, 1)])
    sent = points.withColumn("_corner", F.explode(F.filter(corners, lambda k: k["w"] > 0))).select(*keys, "_corner.r", "_corner.c", "_corner.w")
    cells = grid.select(F.round((F.col("cell_lat") + 90) / cell).cast("long").alias("r"), F.round(F.col("cell_lon") / cell).cast("long").alias("c"), *values)
    met = sent.join(cells, ["r", "c"], "left")
    return met.groupBy(*keys).agg(*[F.when(F.count(v) == F.count(F.lit(1)), F.sum(F.col("w") * F.col(v))).alias(v) for v in values])


def yearly(probes: DataFrame, table: DataFrame) -> DataFrame:
    """Values of a yearly table (at mid-year) at fractional years t, held level beyond its ends; a row a year, broadcast."""
    low = F.floor(F.col("t") - 0.5) + 0.5
    lo, hi = table.select(F.col("at").alias("_lo"), F.col("v").alias("_a")), table.select((F.col("at") - 1).alias("_lo"), F.col("v").alias("_b"))
    steps = lo.join(hi, "_lo", "full")
    value = F.col("_a") + (F.coalesce("_b", "_a") - F.col("_a")) * (F.col("t") - F.col("_lo"))
    return probes.withColumn("_lo", low).join(F.broadcast(steps), "_lo", "left").withColumn("v", F.coalesce(value, F.col("_b"))).drop("_lo", "_a", "_b")
