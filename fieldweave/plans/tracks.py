"""Queries about best tracks: rows from nested records, calibration, consistency, rasters, matching."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import besttracks, cyclones, spheres
from ..sources.views import FIXES, STORMS, fixes, storms, table
from .registry import query

CELL = 10.0
NAUTICAL_KM = 1.852
_GRID = "grid AS (SELECT (b * 10 - 90)::DOUBLE AS cell_lat, (c * 10)::DOUBLE AS cell_lon FROM range(0, 19) t(b), range(0, 36) u(c))"


@query(f"""WITH o AS (SELECT l_orderkey AS sid, l_linenumber AS fix, l_shipdate AS shipped, (l_linenumber * 3 + l_orderkey) % 24 AS hour, ((l_partkey % 360)::DOUBLE - 180) AS lon, l_quantity AS radius FROM lineitem),
k AS (SELECT DISTINCT sid FROM o WHERE year(shipped) BETWEEN 1995 AND 1996)
SELECT sid::VARCHAR AS track_id, fix, (lon + 360) % 360 AS lon, round(radius * {NAUTICAL_KM}, 6) AS radius_km FROM o WHERE sid IN (SELECT sid FROM k) AND hour IN (0, 6, 12, 18) AND year(shipped) BETWEEN 1995 AND 1996""")
def best_track_rows(spark, sf_dir):
    """Storms as nested records, then a row a fix: those of storms with any fix in the years, at four hours of the day."""
    fix = F.struct(F.col("l_linenumber").alias("fix"), F.year("l_shipdate").alias("year"), ((F.col("l_linenumber") * 3 + F.col("l_orderkey")) % 24).alias("hour"), ((F.col("l_partkey") % 360).cast("double") - 180).alias("lon"), F.col("l_quantity").alias("radius"))
    nested = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("sid")).agg(F.collect_list(fix).alias("fixes"))  # a storm has few fixes
    storms_then = nested.where(F.exists("fixes", lambda f: f["year"].between(1995, 1996)))
    rows = storms_then.select("sid", F.explode(F.filter("fixes", lambda f: f["year"].between(1995, 1996) & f["hour"].isin(0, 6, 12, 18))).alias("f"))
    return rows.select(F.col("sid").cast("string").alias("track_id"), "f.fix", F.pmod("f.lon", F.lit(360.0)).alias("lon"), F.round(F.col("f.radius") * NAUTICAL_KM, 6).alias("radius_km"))


@query("""WITH l AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN '# ' || strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN '  ' || strftime(o_orderdate, '%Y-%m-%d') || ' # ' || o_orderpriority ELSE strftime(o_orderdate, '%Y-%m-%d') END AS line FROM orders)
SELECT DISTINCT trim(split_part(line, '#', 1)) AS init FROM l WHERE trim(split_part(line, '#', 1)) <> ''""")
def init_lines(spark, sf_dir):
    """Dates of a file of lines with comments: distinct."""
    day, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 3
    lines = table(spark, sf_dir, "orders").select(F.when(k == 0, F.concat(F.lit("# "), day)).when(k == 1, F.concat(F.lit("  "), day, F.lit(" # "), "o_orderpriority")).otherwise(day).alias("line"))
    return besttracks.init_times(lines, "line").select(F.date_format("init", "yyyy-MM-dd").alias("init"))


@query("""WITH v AS (SELECT lower(n_name) || '_' || s AS v, s FROM nation, (SELECT unnest(['lat', 'lon', 'wind', 'pres', 'rmw']) AS s))
SELECT 'cyclone_' || v AS name, contains('france_wind', v) OR contains('china_pres_sea', v) AS core FROM v""")
def variable_names(spark, sf_dir):
    """Names of agencies' variables; the core ones occur inside a name of the core."""
    rows = table(spark, sf_dir, "nation").select("n_name", F.explode(F.array(*map(F.lit, ("lat", "lon", "wind", "pres", "rmw")))).alias("s"))
    named = rows.select(F.concat_ws("_", F.lower("n_name"), "s").alias("v"))
    return named.select(F.concat(F.lit("cyclone_"), "v").alias("name"), cyclones.is_core(F.col("v"), ["france_wind", "china_pres_sea"]).alias("core"))


@query(f"""WITH {STORMS}, m AS (SELECT regr_slope(wind_a, wind_b) AS a, regr_intercept(wind_a, wind_b) AS b FROM storms)
SELECT sid, fix, round(CASE WHEN wind_b IS NULL THEN wind_a ELSE (wind_a + greatest(0.0, a * wind_b + b)) / 2 END, 6) AS merged FROM storms, m""")
def calibrated_winds(spark, sf_dir):
    return cyclones.calibrated_wind(storms(spark, sf_dir), "wind_a", ["wind_b"]).select("sid", "fix", F.round("merged", 6).alias("merged"))


def _raise(r: str, t: int) -> str:
    top = f"list_max({r})"
    return f"CASE WHEN wind_a >= {t} AND {top} IS NOT NULL THEN [" + ", ".join(f"CASE WHEN list_position({r}, {top}) = {i} THEN greatest({r}[{i}], rmw) ELSE {r}[{i}] END" for i in (1, 2, 3, 4)) + f"] ELSE {r} END AS {r}"


@query(f"""WITH {STORMS}, a AS (SELECT sid, fix, {_raise('r64', 64)}, {_raise('r50', 50)}, {_raise('r34', 34)} FROM storms)
SELECT sid, fix, {', '.join(f"CASE WHEN r50[{i}] IS NOT NULL THEN greatest(r50[{i}], coalesce(r64[{i}], r50[{i}])) END AS r50_{i}, CASE WHEN r34[{i}] IS NOT NULL THEN greatest(r34[{i}], CASE WHEN r50[{i}] IS NOT NULL THEN r50[{i}] ELSE r34[{i}] END, coalesce(r64[{i}], r34[{i}])) END AS r34_{i}" for i in (1, 2, 3, 4))} FROM a""")
def raised_radii(spark, sf_dir):
    found = cyclones.raised_radii(storms(spark, sf_dir))
    return found.select("sid", "fix", *[F.col(r).getItem(i - 1).alias(f"{r}_{i}") for i in (1, 2, 3, 4) for r in ("r50", "r34")])


@query(f"""WITH {STORMS}, p AS (SELECT row_number() OVER () AS k, sid, fix, [{{'r': r64[1], 'v': 64.0}}, {{'r': r50[1], 'v': 50.0}}, {{'r': r34[1], 'v': 34.0}}, {{'r': rmw, 'v': wind_a}}] AS pairs FROM storms),
u AS (SELECT k, sid, fix, unnest(pairs) AS q FROM p), l AS (SELECT k, sid, fix, q.r AS r, q.v AS v, lag(q.r) OVER w AS r0, lag(q.v) OVER w AS v0 FROM u WHERE q.r IS NOT NULL WINDOW w AS (PARTITION BY k ORDER BY q.r, q.v))
SELECT sid, fix, bool_and(r0 IS NULL OR r = r0 OR v <= v0) AS consistent FROM l GROUP BY k, sid, fix""")
def falling_speeds(spark, sf_dir):
    pairs = F.array(*[F.struct(r.alias("radius"), v.alias("speed")) for r, v in [(F.element_at(f"r{t}", 1), F.lit(float(t))) for t in (64, 50, 34)] + [(F.col("rmw"), F.col("wind_a"))]])
    return storms(spark, sf_dir).select("sid", "fix", cyclones.speeds_fall(pairs).alias("consistent"))


@query(f"""WITH {FIXES}, {_GRID}, g AS (SELECT track_id, step, cell_lat, cell_lon, exp(-0.5 * pow({geo.DISTANCE.format(lat0='lat', lon0='lon', lat1='cell_lat', lon1='cell_lon')} / 800, 2)) AS g FROM grid, fixes),
s AS (SELECT *, sum(g) OVER (PARTITION BY track_id, step) AS total FROM g) SELECT cell_lat, cell_lon, round(sum(g / total), 6) AS density FROM s GROUP BY 1, 2""")
def track_density(spark, sf_dir):
    return cyclones.densities(fixes(spark, sf_dir), 800.0, CELL).select("cell_lat", "cell_lon", F.round("density", 6).alias("density"))


@query(f"""WITH {FIXES}, {_GRID}, near AS (SELECT *, {geo.DISTANCE.format(lat0='lat', lon0='lon', lat1='cell_lat', lon1='cell_lon')} AS d FROM grid JOIN fixes ON abs(cell_lat - lat) < 12)
SELECT cell_lat, cell_lon, CASE WHEN bool_or(track_id % 7 = 0) THEN 'NaN'::DOUBLE ELSE greatest(max(wind), 0.0) END AS value, bool_or(track_id % 7 = 0) AS has_nan FROM near WHERE d < 1100 GROUP BY 1, 2""")
def disc_values(spark, sf_dir):
    rows = fixes(spark, sf_dir).withColumn("wind", F.when(F.col("track_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("wind")))
    return cyclones.disc_values(rows, "wind", 1100.0, CELL)


@query()
def matched_tracks(spark, sf_dir):
    """Each step's fixes against those of the same tracks' predictions, which lie where the track was a step before, within 1000 km."""
    rows = fixes(spark, sf_dir)
    found = cyclones.matched(rows, rows.withColumn("step", F.col("step") + 1), 1000.0)
    return found.select("step", "track_id", "match_id", F.round("km", 3).alias("km"))


@query(f"""WITH {FIXES} SELECT track_id, step, ((lat + 90)::BIGINT * 360 + lon::BIGINT) AS point, (lon::BIGINT * 181 + (lat + 90)::BIGINT) AS point_by_lon, abs((step * 6.0) % 24) <= 1e-9 AS whole_day FROM fixes""")
def flat_points(spark, sf_dir):
    """Grid cells as numbers, latitude or longitude first, and steps whose hours are whole days within a tolerance."""
    row, column = (F.col("lat") + 90).cast("long"), F.col("lon").cast("long")
    rest = F.pmod(F.col("step") * 6.0, F.lit(24.0))
    whole = (F.abs(rest) <= 1e-9) | (F.abs(rest - 24) <= 1e-9)
    return fixes(spark, sf_dir).select("track_id", "step", (row * 360 + column).alias("point"), (column * 181 + row).alias("point_by_lon"), whole.alias("whole_day"))


_NUMBER = "CASE WHEN isnan(try_cast(trim({0}) AS DOUBLE)) THEN NULL ELSE try_cast(trim({0}) AS DOUBLE) END"
_QUADRANTS = ", ".join(f"CASE WHEN l_linenumber % 5 >= {i + 1} OR l_linenumber % 5 = 0 THEN ((l_quantity + {i + k})::INT) / {besttracks.NAUTICAL_PER_KM} END AS r{t}_{q}_km" for k, t in enumerate(besttracks.THRESHOLDS) for i, q in enumerate(besttracks.QUADRANT_NAMES))


@query(f"""WITH o AS (SELECT *, l_shipdate::TIMESTAMP + to_hours(((l_linenumber * 3 + l_orderkey) % 24)::INT) AS t, CASE l_partkey % 5 WHEN 0 THEN ' ' WHEN 1 THEN 'NaN' ELSE ' ' || (l_partkey % 90) || '.5 ' END AS lat_text,
  CASE l_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'n/a' ELSE (l_quantity::INT)::VARCHAR END AS wind_text FROM lineitem)
SELECT 'S' || l_orderkey AS track_id, strftime(t, '%Y-%m-%d %H') AS time, {_NUMBER.format('lat_text')} AS lat, ((l_partkey % 360)::DOUBLE + 180) % 360 AS lon, {_NUMBER.format('wind_text')} AS wind,
  CASE WHEN l_suppkey % 7 <> 0 THEN round(l_suppkey / {besttracks.NAUTICAL_PER_KM}, 6) END AS rmw_km, {_QUADRANTS} FROM o WHERE year(t) IN (1995, 1996) AND hour(t) IN (0, 6, 12, 18) AND l_partkey % 5 > 1""")
def converted_storms(spark, sf_dir):
    """Storms as raw nested records, with bytes, blanks and NaN, as rows of two years."""
    hour = (F.col("l_linenumber") * 3 + F.col("l_orderkey")) % 24
    at = F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(hours=hour.cast("int"))
    part, supplier, size = F.col("l_partkey") % 5, F.col("l_suppkey") % 4, F.col("l_quantity").cast("int")
    lat = F.when(part == 0, " ").when(part == 1, "NaN").otherwise(F.concat(F.lit(" "), (F.col("l_partkey") % 90).cast("string"), F.lit(".5 ")))
    wind = F.when(supplier == 0, "").when(supplier == 1, "n/a").otherwise(size.cast("string")).cast("binary")
    there = F.when(F.col("l_linenumber") % 5 == 0, 4).otherwise(F.col("l_linenumber") % 5)  # how many radii a record holds
    radii = [F.slice(F.array(*[(F.col("l_quantity") + i + k).cast("int").cast("string") for i in range(4)]), F.lit(1), there).alias(f"r{t}") for k, t in enumerate(besttracks.THRESHOLDS)]
    rmw = F.when(F.col("l_suppkey") % 7 == 0, float("nan")).otherwise(F.col("l_suppkey").cast("double"))
    fix = F.struct(at.alias("time"), lat.alias("lat"), ((F.col("l_partkey") % 360).cast("double") - 180).alias("lon"), F.lit(1000.0).alias("pressure"), wind.alias("wind"), rmw.alias("rmw"), *radii)
    nested = table(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("S"), F.col("l_orderkey")).cast("binary").alias("sid")).agg(F.collect_list(fix).alias("fixes"))  # a storm has few fixes
    found = besttracks.converted(nested, [1995, 1996])
    return found.select("track_id", F.date_format("time", "yyyy-MM-dd HH").alias("time"), "lat", "lon", "wind", F.round("rmw_km", 6).alias("rmw_km"), *[f"r{t}_{q}_km" for t in besttracks.THRESHOLDS for q in besttracks.QUADRANT_NAMES])


@query("""WITH v AS (SELECT 'existence' AS kind, NULL AS variable UNION ALL SELECT 'existence', lower(n_name) FROM nation UNION ALL SELECT k, lower(n_name) || '_r' || t FROM nation, (VALUES ('scalar'), ('shape')) a(k), (VALUES (34), (50), (64)) b(t)
  UNION ALL SELECT 'category', lower(n_name) || '_cat' FROM nation),
s AS (SELECT * FROM (VALUES ('existence', 'exists_sparse'), ('existence', 'exists_disc'), ('existence', 'exists_gaussian_unit_mode'), ('existence', 'exists_gaussian_probability'), ('scalar', 'sparse'), ('scalar', 'disc'), ('category', 'sparse'), ('category', 'disc'), ('shape', 'shape')) t(kind, suffix))
SELECT DISTINCT 'cyclone_' || coalesce(variable || '_', '') || suffix AS name FROM v JOIN s USING (kind)""")
def gridded_names(spark, sf_dir):
    """Names on a grid of agencies' existence, radii of thresholds, shapes and categories."""
    agency = F.lower("n_name")
    nations = table(spark, sf_dir, "nation")
    many = nations.select(F.explode(F.array(F.lit("scalar"), F.lit("shape"))).alias("kind"), agency.alias("a")).select("kind", "a", F.explode(F.array(*map(F.lit, besttracks.THRESHOLDS))).alias("t"))
    listed = many.select("kind", F.concat("a", F.lit("_r"), F.col("t").cast("string")).alias("variable"))
    for kind, name in (("existence", agency), ("category", F.concat(agency, F.lit("_cat")))):
        listed = listed.unionByName(nations.select(F.lit(kind).alias("kind"), name.alias("variable")))
    return besttracks.gridded_names(listed.unionByName(spark.range(1).select(F.lit("existence").alias("kind"), F.lit(None).cast("string").alias("variable"))))


_BETWEEN = geo.DISTANCE.format(lat0="lat0", lon0="lon0", lat1="lat", lon1="lon")
_EAST = "((lon - lon0 >= 0 AND lon - lon0 < 180) OR lon - lon0 < -180)"


@query(f"""WITH {FIXES}, p AS (SELECT *, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0, lag(wind) OVER w AS w0 FROM fixes WINDOW w AS (PARTITION BY track_id ORDER BY step)),
r AS (SELECT *, {_BETWEEN} AS km, CASE WHEN {_EAST} AND lat >= lat0 THEN w0 * 20 WHEN {_EAST} THEN w0 * 10 WHEN lat < lat0 THEN w0 * 40 END AS radius FROM p WHERE lat0 IS NOT NULL)
SELECT track_id, step, coalesce(km < radius, false) AS inside, coalesce(km < radius + 200, false) AS with_margin FROM r""")
def fixes_in_quadrants(spark, sf_dir):
    """Whether a track's next fix lies in the quadrants of the one before, whose north-western radius is unknown."""
    track = W.partitionBy("track_id").orderBy("step")
    rows = fixes(spark, sf_dir).withColumns({f"{c}0": F.lag(c).over(track) for c in ("lat", "lon", "wind")}).where("lat0 is not null")
    radii = F.array(*[F.col("wind0") * share for share in (20.0, 10.0, 40.0)], F.lit(None).cast("double"))
    inside = lambda margin: spheres.in_quadrants(F.col("lat"), F.col("lon"), F.col("lat0"), F.col("lon0"), radii, margin)
    return rows.select("track_id", "step", inside(0.0).alias("inside"), inside(200.0).alias("with_margin"))
