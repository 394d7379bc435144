"""Queries about the sun, the sphere, grids and meshes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, solar
from ..operators import graphs, meshes, spheres, tracker
from ..sources.tables import ship
from ..sources.views import FIELD, FIXES, STORMS, field, fixes, micros, points, storms, table
from .registry import query

CELL = 10.0
#: A grid of 10 degrees: p in 0..1 and a scalar of each cell that has events.
GRID = f"""{FIELD}, cells AS (SELECT round(lat / 10) * 10 AS cell_lat, (round(lon / 10) * 10) % 360 AS cell_lon, round(avg(value) / 1000, 4) AS p, round(max(value), 3) AS v
FROM field WHERE NOT isnan(value) GROUP BY 1, 2)"""


def grid(spark, sf_dir):
    rows = field(spark, sf_dir).where(~F.isnan("value"))
    return rows.groupBy((F.round(F.col("lat") / 10) * 10).alias("cell_lat"), (F.round(F.col("lon") / 10) * 10 % 360).alias("cell_lon")).agg(F.round(F.avg("value") / 1000, 4).alias("p"), F.round(F.max("value"), 3).alias("v"))


def _plain(c, digits=6):
    return F.round(c, digits) + 0.0


_RAD = "radians({})".format
_YEAR = solar.JULIAN_YEAR


_ORBIT, _ANOMALY, _MEAN = (f"{a} + {b} * d / {_YEAR}" for a, b in (solar.ORBIT_ANGLE, solar.ANOMALY, solar.MEAN_LONGITUDE))
_L, _E, _AU = solar.TRUE_LONGITUDE, solar.TIME_EQUATION, solar.DISTANCE_AU


@query(f"""WITH e AS (SELECT event_id, radians(user_id * 37 % 181 - 90) AS a, radians(event_id * 53 % 360) AS b, epoch_us(ts) / 8.64e10 + ({solar.UNIX_JULIAN} - {solar.J2000_JULIAN}) AS day FROM events),
s AS (SELECT *, day + (i - 360) / 24.0 / 360 AS d, CASE WHEN i IN (0, 360) THEN 0.5 ELSE 1.0 END AS w FROM e, range(0, 361) t(i)),
o AS (SELECT *, {_ORBIT} AS orbit, {_ANOMALY} AS anomaly, {_MEAN} AS mean FROM s),
q AS (SELECT *, sin({solar.OBLIQUITY}) * sin({_L[0]} + {_L[1]} * d / {_YEAR} + {_L[2]} * sin(orbit) + {_L[3]} * cos(orbit) + {_L[4]} * sin(2 * orbit) + {_L[5]} * cos(2 * orbit)) AS decl,
{_E[0]} * sin(2 * mean) + {_E[1]} * sin(anomaly) + {_E[2]} * sin(anomaly) * cos(2 * mean) + {_E[3]} * sin(4 * mean) + {_E[4]} * sin(2 * anomaly) AS eq, {_AU[0]} + {_AU[1]} * sin(orbit) + {_AU[2]} * cos(orbit) AS au FROM o)
SELECT event_id, round(sum(w * 1361.0 / (au * au) * greatest(0.0, cos(a) * sqrt(1 - decl * decl) * cos(2 * pi() * (d - floor(d) + eq / 86400) + b) + sin(a) * decl)) * 10 / 1000, 3) AS kilojoules FROM q GROUP BY 1""")
def solar_radiation(spark, sf_dir):
    ship(spark)
    day, lat = solar.j2000_days(micros(F.col("ts"))), (F.col("user_id") * 37 % 181 - 90).cast("double")
    joules = solar.integrated(day, lat, (F.col("event_id") * 53 % 360).cast("double"), F.lit(1361.0))
    return table(spark, sf_dir, "events").select("event_id", F.round(joules / 1000, 3).alias("kilojoules"))


@query("""WITH y AS (SELECT year(o_orderdate) + 0.5 AS yr, round(avg(o_totalprice), 2) AS v FROM orders GROUP BY 1),
p AS (SELECT o_orderkey, year(o_orderdate) + (dayofyear(o_orderdate) - 1) / (CASE WHEN dayofyear(make_date(year(o_orderdate), 12, 31)) = 366 THEN 366.0 ELSE 365.0 END) AS t FROM orders)
SELECT o_orderkey, round(coalesce(lo.v + (coalesce(hi.v, lo.v) - lo.v) * (t - lo.yr), hi.v), 4) AS interpolated
FROM p LEFT JOIN y lo ON lo.yr = floor(t - 0.5) + 0.5 LEFT JOIN y hi ON hi.yr = floor(t - 0.5) + 1.5""")
def yearly_interpolation(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    yearly = orders.groupBy((F.year("o_orderdate") + 0.5).alias("at")).agg(F.round(F.avg("o_totalprice"), 2).alias("v"))
    found = spheres.yearly(orders.select("o_orderkey", geo.fractional_year(F.col("o_orderdate")).alias("t")), yearly)
    return found.select("o_orderkey", F.round("v", 4).alias("interpolated"))


_XYZ = lambda lat, lon: (f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))")
_EDGES = """edges AS (SELECT event_id, (user_id * 37 % 181 - 90)::DOUBLE AS s_lat, (event_id * 53 % 360)::DOUBLE AS s_lon, (user_id * 31 % 179 - 89)::DOUBLE AS r_lat, (event_id * 71 % 360)::DOUBLE AS r_lon FROM events),
p AS (SELECT *, cos(radians(s_lat)) * cos(radians(s_lon)) AS x, cos(radians(s_lat)) * sin(radians(s_lon)) AS y, sin(radians(s_lat)) AS z, radians(r_lat) AS a, radians(r_lon) AS b FROM edges),
q AS (SELECT *, cos(b) * x + sin(b) * y AS x1, cos(b) * y - sin(b) * x AS y1 FROM p),
r AS (SELECT event_id, cos(a) * x1 + sin(a) * z - 1 AS dx, y1 AS dy, cos(a) * z - sin(a) * x1 AS dz FROM q)"""


def _edges(spark, sf_dir):
    u, e = F.col("user_id"), F.col("event_id")
    columns = {"s_lat": u * 37 % 181 - 90, "s_lon": e * 53 % 360, "r_lat": u * 31 % 179 - 89, "r_lon": e * 71 % 360}
    return table(spark, sf_dir, "events").select("event_id", *[c.cast("double").alias(n) for n, c in columns.items()])


@query(f"WITH {_EDGES} SELECT event_id, round(dx, 6) + 0.0 AS dx, round(dy, 6) + 0.0 AS dy, round(dz, 6) + 0.0 AS dz FROM r")
def local_positions(spark, sf_dir):
    relative = spheres.local_position(*[F.col(c) for c in ("s_lat", "s_lon", "r_lat", "r_lon")])
    return _edges(spark, sf_dir).select("event_id", *[_plain(c).alias(n) for c, n in zip(relative, ("dx", "dy", "dz"), strict=True)])


@query(f"""WITH {_EDGES}, l AS (SELECT *, sqrt(dx * dx + dy * dy + dz * dz) AS length FROM r), m AS (SELECT max(length) AS m FROM l)
SELECT event_id, round(dx / m, 6) + 0.0 AS dx, round(dy / m, 6) + 0.0 AS dy, round(dz / m, 6) + 0.0 AS dz, round(length / m, 6) + 0.0 AS length FROM l, m""")
def edge_features(spark, sf_dir):
    return spheres.edge_features(_edges(spark, sf_dir)).select("event_id", *[_plain(F.col(c)).alias(c) for c in ("dx", "dy", "dz", "length")])


@query(f"WITH {FIELD} SELECT event_id, round(sin(radians(lat)), 6) + 0.0 AS sin_lat, round(sin(radians(lon)), 6) + 0.0 AS sin_lon, round(cos(radians(lon)), 6) + 0.0 AS cos_lon FROM field")
def spatial_features(spark, sf_dir):
    lat, lon = F.radians("lat"), F.radians("lon")
    return field(spark, sf_dir).select("event_id", _plain(F.sin(lat)).alias("sin_lat"), _plain(F.sin(lon)).alias("sin_lon"), _plain(F.cos(lon)).alias("cos_lon"))


@query(f"""WITH {FIXES}, c AS (SELECT *, least(cos(radians(least(90.0, lat + wind / 20004 * 180))), cos(radians(greatest(-90.0, lat - wind / 20004 * 180)))) AS narrow FROM fixes)
SELECT track_id, step, round(wind * 2 / 111.3, 6) AS side_lat, round(CASE WHEN narrow <= 0 THEN 360.0 ELSE least(wind * 2 / 111.3 / narrow, 360.0) END, 6) AS side_lon FROM c""")
def disc_boxes(spark, sf_dir):
    lat, lon = spheres.box_sides(F.col("lat"), F.col("wind"))
    return fixes(spark, sf_dir).select("track_id", "step", F.round(lat, 6).alias("side_lat"), F.round(lon, 6).alias("side_lon"))


@query(f"""WITH {FIXES}, {GRID}, near AS (SELECT track_id, step, cells.*, {_XYZ('cell_lat', 'cell_lon')[0]} AS x, {_XYZ('cell_lat', 'cell_lon')[1]} AS y, {_XYZ('cell_lat', 'cell_lon')[2]} AS z FROM fixes JOIN cells ON abs(cell_lat - lat) < 15
AND {geo.DISTANCE.format(lat0='lat', lon0='lon', lat1='cell_lat', lon1='cell_lon')} < 1500),
m AS (SELECT track_id, step, count(*) AS cells, sum(p) AS p_sum, sum(p * v) / sum(p) AS mean_v, sum(p * x) AS x, sum(p * y) AS y, sum(p * z) AS z, max(struct_pack(p := p, a := -cell_lat, b := -cell_lon)) AS mode FROM near GROUP BY 1, 2)
SELECT track_id, step, cells, round(least(1.0, p_sum / (SELECT count(*) FROM cells) * 7) + 1e-9, 6) AS existence, round(mean_v + 1e-9, 4) AS mean_v, round(degrees(asin(z / sqrt(x*x + y*y + z*z))), 4) + 0.0 AS mean_lat,
round((degrees(atan2(y, x)) + 360) % 360, 4) % 360 + 0.0 AS mean_lon, -mode.a + 0.0 AS mode_lat, -mode.b + 0.0 AS mode_lon FROM m""")
def disc_statistics(spark, sf_dir):
    cells = grid(spark, sf_dir)
    found = spheres.disc_statistics(fixes(spark, sf_dir), cells, ["track_id", "step"], 1500.0, CELL, ["v"])
    n = cells.agg(F.count(F.lit(1)).alias("n"))
    out = found.join(F.broadcast(n))  # n is one row
    existence = F.least(F.lit(1.0), F.col("p_sum") / F.col("n") * 7)
    return out.select("track_id", "step", "cells", F.round(existence + 1e-9, 6).alias("existence"), F.round(F.col("mean_v") + 1e-9, 4).alias("mean_v"), _plain(F.col("mean_lat"), 4).alias("mean_lat"),
                      (F.round("mean_lon", 4) % 360 + 0.0).alias("mean_lon"), (F.col("mode_lat") + 0.0).alias("mode_lat"), (F.col("mode_lon") + 0.0).alias("mode_lon"))


@query(f"""WITH {FIXES}, {GRID}, pos AS (SELECT *, (lat + 90) / 10 AS r, lon / 10 AS c FROM fixes),
k AS (SELECT track_id, step, least(floor(r), 17) + i AS r1, (floor(c) + j)::BIGINT % 36 AS c1, (CASE WHEN i = 1 THEN r - least(floor(r), 17) ELSE 1 - r + least(floor(r), 17) END) * (CASE WHEN j = 1 THEN c - floor(c) ELSE 1 - c + floor(c) END) AS w FROM pos, range(0, 2) t(i), range(0, 2) u(j))
SELECT track_id, step, CASE WHEN count(p) = count(*) THEN round(sum(w * p), 6) END AS p, CASE WHEN count(v) = count(*) THEN round(sum(w * v), 4) END AS v
FROM k LEFT JOIN cells ON cell_lat = r1 * 10 - 90 AND cell_lon = c1 * 10 WHERE w > 0 GROUP BY 1, 2""")
def bilinear_reads(spark, sf_dir):
    found = spheres.bilinear(fixes(spark, sf_dir), grid(spark, sf_dir), ["track_id", "step"], CELL, ["p", "v"])
    return found.select("track_id", "step", F.round("p", 6).alias("p"), F.round("v", 4).alias("v"))


@query(f"""WITH {FIXES}, shapes AS (SELECT track_id, step, lat, lon, [wind, wind * 0.75, wind * 0.5, CASE WHEN step % 3 = 0 THEN NULL ELSE wind * 0.9 END] AS radii FROM fixes),
sub AS (SELECT (b * 10 - 90)::DOUBLE AS cell_lat, (c * 10)::DOUBLE AS cell_lon, greatest(-90.0, least(90.0, b * 10 - 90 + ((i + 0.5) / 4 - 0.5) * 10)) AS la, (c * 10 + ((j + 0.5) / 4 - 0.5) * 10 + 360) % 360 AS lo FROM range(0, 19) t(b), range(0, 36) u(c), range(0, 4) v(i), range(0, 4) w(j)),
near AS (SELECT *, (lo - lon >= 0 AND lo - lon < 180) OR lo - lon < -180 AS east, la >= lat AS north, {geo.DISTANCE.format(lat0='la', lon0='lo', lat1='lat', lon1='lon')} AS d FROM sub JOIN shapes ON abs(la - lat) < 10)
SELECT cell_lat, cell_lon, round(count(*) / 16, 6) AS covered FROM near WHERE d < coalesce(radii[CASE WHEN east AND north THEN 1 WHEN east THEN 2 WHEN NOT north THEN 3 ELSE 4 END], 0.0) GROUP BY 1, 2""")
def quadrant_cover(spark, sf_dir):
    w = F.col("wind")
    shapes = fixes(spark, sf_dir).withColumn("radii", F.array(w, w * 0.75, w * 0.5, F.when(F.col("step") % 3 != 0, w * 0.9)))
    found = spheres.quadrant_raster(shapes, "radii", F.lit(1), CELL, 4)
    return found.select("cell_lat", "cell_lon", F.round("covered", 6).alias("covered"))


@query(f"""WITH {FIXES} SELECT (round((lat + 90) / 10) * 10 - 90) AS cell_lat, (round(lon / 10) * 10) % 360 AS cell_lon, arg_max(wind, struct_pack(s := step, t := track_id)) AS wind FROM fixes GROUP BY 1, 2""")
def sparse_raster(spark, sf_dir):
    """The last point that falls in a cell sets it."""
    cell = [(F.round((F.col("lat") + 90) / CELL) * CELL - 90).alias("cell_lat"), (F.round(F.col("lon") / CELL) * CELL % 360).alias("cell_lon")]
    return fixes(spark, sf_dir).groupBy(*cell).agg(F.max_by("wind", F.struct("step", "track_id")).alias("wind"))


@query(f"""WITH {STORMS}, i AS (SELECT unnest(['NE', 'SE', 'SW', 'NW']) AS quadrant, unnest(r34) AS radius, wind_a FROM storms) SELECT quadrant, count(radius) AS known, round(avg(radius), 6) AS mean_radius FROM i WHERE wind_a >= 34 GROUP BY 1""")
def quadrant_radii(spark, sf_dir):
    names = F.array(*map(F.lit, ("NE", "SE", "SW", "NW")))
    rows = storms(spark, sf_dir).where("wind_a >= 34").select(F.explode(F.arrays_zip(names.alias("quadrant"), F.col("r34").alias("radius"))).alias("q")).select("q.*")
    return rows.groupBy("quadrant").agg(F.count("radius").alias("known"), F.round(F.avg("radius"), 6).alias("mean_radius"))


@query("""WITH g AS (SELECT DISTINCT (p_size * 5 - 90)::DOUBLE AS lat FROM part WHERE p_size <= 36 UNION SELECT -90.0 UNION SELECT 90.0),
w AS (SELECT lat, CASE WHEN abs(lat) = 90 THEN pow(sin(radians(5) / 4), 2) ELSE cos(radians(lat)) * sin(radians(5) / 2) END AS w FROM g)
SELECT lat, round(w / (SELECT avg(w) FROM w), 9) AS weight FROM w""")
def polar_latitude_weights(spark, sf_dir):
    lat = table(spark, sf_dir, "part").where("p_size <= 36").select((F.col("p_size") * 5 - 90).cast("double").alias("lat"))
    lat = lat.unionByName(spark.createDataFrame([(-90.0,), (90.0,)], "lat double")).distinct()
    weighted = lat.withColumn("w", geo.polar_weight(F.col("lat"), 5.0))
    mean = weighted.agg(F.avg("w").alias("m"))
    return weighted.join(F.broadcast(mean)).select("lat", F.round(F.col("w") / F.col("m"), 9).alias("weight"))  # the mean is one row


@query()
def mesh_faces(spark, sf_dir):
    """The face of the icosahedral mesh of three splits that holds each point, and its vertices."""
    return meshes.containing_faces(points(spark, sf_dir), 3)


@query()
def mesh_closest(spark, sf_dir):
    """The vertex of that mesh closest to each point."""
    return meshes.closest_vertices(points(spark, sf_dir), 3).withColumn("distance", F.round("distance", 9))


@query()
def ellipsoid_distances(spark, sf_dir):
    """Geodesic km on the WGS84 ellipsoid between senders and receivers."""
    ship(spark)
    d = geo.ellipsoid_km("s_lat", "s_lon", "r_lat", "r_lon")
    return _edges(spark, sf_dir).select("event_id", F.round(d, 6).alias("km"))


@query(f"""WITH {FIXES}, e AS (SELECT track_id AS sender, step % 50 AS receiver, wind FROM fixes), x AS (SELECT *, exp((wind - max(wind) OVER (PARTITION BY receiver)) / 100) AS w FROM e)
SELECT receiver, count(*) AS edges, round(sum(w * sender) / sum(w), 6) AS attended FROM x GROUP BY 1""")
def receiver_attention(spark, sf_dir):
    edges = fixes(spark, sf_dir).select(F.col("track_id").alias("sender"), (F.col("step") % 50).alias("receiver"), "wind")
    found = graphs.attention(edges, "receiver", F.col("wind") / 100, F.col("sender"))
    return found.select("receiver", "edges", F.round("attended", 6).alias("attended"))


#: Scalars of the tracked cells, from their greatest value: (name, share of the value), with radii by quadrant.
SCALARS = {"wind": 0.3, "rmw": 0.05} | {f"{name}_{i}": share * i / 4 for name, share in (("r34", 0.2), ("r50", 0.1), ("r64", 0.08)) for i in (1, 2, 3, 4)}


def _tracking_grid(spark, sf_dir):
    rows = field(spark, sf_dir).where(~F.isnan("value"))
    cells = rows.groupBy(F.col("member").alias("run"), "step", (F.round(F.col("lat") / 10) * 10).alias("cell_lat"), (F.round(F.col("lon") / 10) * 10 % 360).alias("cell_lon"))
    return cells.agg((F.max("value") / 1000).alias("p"), *[(F.max("value") * share).alias(c) for c, share in SCALARS.items()])


@query()
def tracked_cyclones(spark, sf_dir):
    """Tracks over every 6-hour step of the field, a run a member, with scalars that obey physics."""
    found = tracker.consistent(tracker.track(_tracking_grid(spark, sf_dir), None, TRACKING, list(SCALARS)))
    radii = [F.transform(c, lambda r: F.round(r, 6)).alias(c) for c in ("r34", "r50", "r64")]
    return found.select("run", "track", "step", *[_plain(F.col(c), 4).alias(c) for c in ("lat", "lon")], F.round("existence", 6).alias("existence"), "merged_into", *[F.round(c, 6).alias(c) for c in ("wind", "rmw")], *radii, "radii_agree")


#: Distances for cells of 10 degrees.
TRACKING = tracker.Settings(cell=CELL, mode_km=2000.0, mean_km=2000.0, existence_km=3000.0, refinement_km=2000.0, scalar_km=2000.0, apart_km=2500.0, prune_km=1500.0, box=30.0, box_threshold=0.05, least_steps=2)
