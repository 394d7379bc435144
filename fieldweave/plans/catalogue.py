"""The queries of the library's own operators, each over whole tables, with DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import cyclones, fields, graphs, ordering
from ..sources.views import FIELD, FIXES, POINTS, STORMS, field, fixes, points, storms, table
from ..streaming import daily
from . import campaign, composed, deep, forecasts, geometry, gridded, orders, records, tracks  # noqa: F401  (all but the first list queries of their own)
from .registry import ORACLES, QUERIES, query


def _rounded(*names: str):
    return [F.round(n, 6).alias(n) for n in names]


# ------------------------------------------------------------------ fields


_FOLD = "CASE WHEN NOT bool_or(isnan(value)) THEN round({}(value), 6) END AS daily_{}"
_FOLDS = ", ".join(_FOLD.format(f, n) for f, n in (("avg", "mean"), ("sum", "sum"), ("min", "least"), ("max", "greatest")))


def _folded(rows, *keys):
    return rows.select(*keys, "day", "steps", *_rounded("daily_mean", "daily_sum", "daily_least", "daily_greatest"))


@query(f"WITH {FIELD} SELECT member, variable, (floor((step - 1) / 4))::BIGINT AS day, count(DISTINCT step) AS steps, {_FOLDS} FROM field WHERE variable <> 'error' GROUP BY 1, 2, 3 HAVING count(DISTINCT step) = 4")
def daily_fold(spark, sf_dir):
    """Whole days of each member, of the variables that a store takes."""
    return _folded(fields.daily_fold(field(spark, sf_dir).where("variable <> 'error'"), ["member", "variable"]), "member", "variable")


@query(f"WITH {FIELD} SELECT member, variable, (floor((step - 1) / 4))::BIGINT AS day, count(DISTINCT step) AS steps, {_FOLDS} FROM field GROUP BY 1, 2, 3 HAVING count(DISTINCT step) = 4")
def whole_day_fold(spark, sf_dir):
    return _folded(fields.daily_fold(field(spark, sf_dir), ["member", "variable"]), "member", "variable")


@query(f"WITH {FIELD} SELECT member, variable, (floor((step - 1) / 4))::BIGINT AS day, count(DISTINCT step) AS steps, {_FOLDS} FROM field GROUP BY 1, 2, 3")
def partial_day_fold(spark, sf_dir):
    """All days, whatever they lack."""
    return _folded(fields.daily_fold(field(spark, sf_dir), ["member", "variable"], whole=False), "member", "variable")


@query(f"WITH {FIELD} SELECT variable, count(*) AS n, round(avg(isnan(value)::INT), 9) AS missing_share FROM field GROUP BY 1")
def missing_share(spark, sf_dir):
    return field(spark, sf_dir).groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.isnan("value").cast("int")), 9).alias("missing_share"))


@query(f"WITH {FIELD} SELECT * FROM (SELECT event_id, member, variable, step, row_number() OVER (PARTITION BY member, variable ORDER BY step DESC, event_id DESC)::INT AS age FROM field) WHERE age <= 2")
def latest_frames(spark, sf_dir):
    return fields.latest_frames(field(spark, sf_dir), ["member", "variable"], 2).select("event_id", "member", "variable", "step", "age")


@query(f"""WITH {FIELD}, stats AS (SELECT variable, avg(value) AS m, stddev_pop(value) AS s FROM field WHERE NOT isnan(value) GROUP BY 1)
SELECT event_id, variable, round((value - m) / s, 6) AS value FROM field JOIN stats USING (variable) WHERE NOT isnan(value)""")
def normalized_values(spark, sf_dir):
    f = field(spark, sf_dir)
    return fields.normalize(f, fields.statistics(f)).where(~F.isnan("value")).select("event_id", "variable", *_rounded("value"))


@query(f"""WITH {FIELD}, r AS (SELECT event_id, member, variable, value - lag(value) OVER (PARTITION BY member, variable, lat ORDER BY step, event_id) AS residual FROM field)
SELECT event_id, member, variable, round(residual, 6) AS residual FROM r WHERE residual IS NOT NULL AND NOT isnan(residual)""")
def residuals(spark, sf_dir):
    """Differences along the steps of a member, variable and band of latitude."""
    before = F.lag("value").over(W.partitionBy("member", "variable", "lat").orderBy("step", "event_id"))
    rows = field(spark, sf_dir).withColumn("residual", F.col("value") - before)
    return rows.where(F.col("residual").isNotNull() & ~F.isnan("residual")).select("event_id", "member", "variable", *_rounded("residual"))


@query(f"WITH {FIELD} SELECT event_id, variable, CASE WHEN isnan(value) THEN -1.0 ELSE value END AS value, isnan(value) AS was_nan FROM field")
def nan_filled(spark, sf_dir):
    return fields.fill_nan(field(spark, sf_dir), -1.0).select("event_id", "variable", "value", "was_nan")


@query(f"""WITH {FIELD}, w AS (SELECT *, (sin(radians(least(90.0, lat + 0.5))) - sin(radians(greatest(-90.0, lat - 0.5)))) / 2 AS w FROM field WHERE NOT isnan(value))
SELECT variable, round(sum(value * w) / sum(w), 6) AS weighted_mean FROM w GROUP BY 1""")
def latitude_weighted_mean(spark, sf_dir):
    w = fields.latitude_weight(F.col("lat"), 1.0)
    return field(spark, sf_dir).where(~F.isnan("value")).groupBy("variable").agg(F.round(F.sum(F.col("value") * w) / F.sum(w), 6).alias("weighted_mean"))


@query("SELECT p_partkey, round(p_size / avg(p_size) OVER (), 9) AS level_weight FROM part")
def level_weights(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    mean = parts.agg(F.avg("p_size").alias("mean"))
    return parts.join(F.broadcast(mean)).select("p_partkey", F.round(F.col("p_size") / F.col("mean"), 9).alias("level_weight"))  # the mean is one row


@query("""SELECT l_returnflag AS variable, round(avg(abs(l_quantity - l_extendedprice / 1500) * (l_linenumber / 4.0)), 6) AS mae,
round(avg(pow(l_quantity - l_extendedprice / 1500, 2) * (l_linenumber / 4.0)), 6) AS mse FROM lineitem GROUP BY 1""")
def weighted_losses(spark, sf_dir):
    d, w = F.col("l_quantity") - F.col("l_extendedprice") / 1500, F.col("l_linenumber") / 4.0
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("variable")).agg(F.round(F.avg(F.abs(d) * w), 6).alias("mae"), F.round(F.avg(d * d * w), 6).alias("mse"))


@query("""WITH e AS (SELECT l_orderkey, count(*) AS members, avg(abs(l_quantity - l_orderkey % 50)) AS error FROM lineitem GROUP BY 1),
p AS (SELECT a.l_orderkey, sum(abs(a.l_quantity - b.l_quantity)) AS pairs FROM lineitem a JOIN lineitem b USING (l_orderkey) GROUP BY 1)
SELECT l_orderkey, members, round(error - CASE WHEN members > 1 THEN pairs / (2.0 * members * (members - 1)) ELSE 0 END, 6) AS crps FROM e JOIN p USING (l_orderkey)""")
def ensemble_crps(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    return fields.crps(rows, ["l_orderkey"], "l_quantity", F.col("l_orderkey") % 50).select("l_orderkey", "members", *_rounded("crps"))


@query(f"WITH {FIELD} SELECT variable, step, round(avg(value), 6) AS member_mean, count(DISTINCT member) AS members FROM field WHERE NOT isnan(value) GROUP BY 1, 2")
def ensemble_mean(spark, sf_dir):
    return field(spark, sf_dir).where(~F.isnan("value")).groupBy("variable", "step").agg(F.round(F.avg("value"), 6).alias("member_mean"), F.count_distinct("member").alias("members"))


@query("""SELECT l_orderkey, l_linenumber, 'cyclone_' || name AS variable, v AS value FROM (SELECT l_orderkey, l_linenumber, unnest(['l_quantity', 'l_discount', 'l_tax']) AS name, unnest([l_quantity, l_discount, l_tax]) AS v FROM lineitem)""")
def packed_variables(spark, sf_dir):
    return fields.packed(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "cyclone_")


@query("SELECT l_orderkey, max(l_quantity) AS l_quantity, max(l_tax) AS l_tax FROM lineitem WHERE l_linenumber = 1 GROUP BY 1")
def unpacked_variables(spark, sf_dir):
    rows = fields.packed(table(spark, sf_dir, "lineitem").where("l_linenumber = 1"), ["l_orderkey"], ["l_quantity", "l_tax"], "")
    return fields.unpacked(rows, ["l_orderkey"], ["l_quantity", "l_tax"])


@query("""SELECT l_orderkey, l_linenumber, round_even(l_extendedprice / pow(2.0, floor(log2(abs(l_extendedprice))) - 7), 0) * pow(2.0, floor(log2(abs(l_extendedprice))) - 7) AS kept FROM lineitem""")
def bit_rounded(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", geo.bit_round(F.col("l_extendedprice"), 7).alias("kept"))


# ------------------------------------------------------------------ time and geometry

_SECONDS = "(epoch_us(ts) // 1000000)"


@query(f"""SELECT event_id, round({_SECONDS} / (365.24219 * 86400) - floor({_SECONDS} / (365.24219 * 86400)), 6) AS year_progress,
round((({_SECONDS} % 86400) / 86400.0 + (event_id * 53 % 360) / 360.0) % 1.0 + 1e-9, 6) AS day_progress FROM events""")
def time_progress(spark, sf_dir):
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.date_trunc("second", F.col("ts")))
    lon = F.col("event_id") * 53 % 360
    return table(spark, sf_dir, "events").select("event_id", F.round(geo.year_progress(seconds), 6).alias("year_progress"), F.round(geo.day_progress(seconds, lon) + 1e-9, 6).alias("day_progress"))


@query("SELECT event_id, " + ", ".join(f"round({f}(value * {2 * 3.141592653589793 * k / 1000}), 6) AS {f}{k}" for f in ("cos", "sin") for k in (1, 2)) + " FROM events")
def fourier_features(spark, sf_dir):
    names = ["cos1", "cos2", "sin1", "sin2"]
    return table(spark, sf_dir, "events").select("event_id", *[F.round(c, 6).alias(n) for c, n in zip(geo.fourier(F.col("value"), 1000.0, 2), names, strict=True)])


@query(f"WITH {FIELD} SELECT event_id, round(cos(radians(lat)) * cos(radians(lon)), 9) + 0.0 AS x, round(cos(radians(lat)) * sin(radians(lon)), 9) + 0.0 AS y, round(sin(radians(lat)), 9) + 0.0 AS z FROM field")
def grid_positions(spark, sf_dir):
    xyz = geo.cartesian(F.col("lat"), F.col("lon"))
    return field(spark, sf_dir).select("event_id", *[(F.round(c, 9) + 0.0).alias(n) for c, n in zip(xyz, "xyz", strict=True)])


@query(f"WITH {FIELD} SELECT event_id, lat, lon FROM field WHERE lat BETWEEN -20 AND 40 AND (lon >= 340 OR lon <= 40)")
def wrapped_box(spark, sf_dir):
    return field(spark, sf_dir).where(geo.in_box(F.col("lat"), F.col("lon"), 10.0, 10.0, 60.0, 60.0)).select("event_id", "lat", "lon")


@query(f"WITH {FIELD} SELECT event_id, (floor((lat + 90) / 2.5 + 0.5) * 2.5 - 90) AS cell_lat, (floor(lon / 2.5 + 0.5) * 2.5) % 360 AS cell_lon FROM field")
def nearest_cells(spark, sf_dir):
    cell = lambda x: F.floor(x / 2.5 + 0.5).cast("double") * 2.5
    return field(spark, sf_dir).select("event_id", (cell(F.col("lat") + 90) - 90).alias("cell_lat"), (cell(F.col("lon")) % 360).alias("cell_lon"))


# ------------------------------------------------------------------ graphs


@query("SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p_size, -1.0)::DOUBLE AS sender_size FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10")
def gathered_nodes(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    nodes = table(spark, sf_dir, "part").where("p_size > 10").withColumn("size", F.col("p_size").cast("double"))
    return graphs.gather(edges, nodes, "l_partkey", "p_partkey", "size", -1.0, "sender_size").select("l_orderkey", "l_linenumber", "l_partkey", "sender_size")


@query("SELECT s_suppkey, coalesce(t, 0.0) AS received FROM supplier LEFT JOIN (SELECT l_suppkey, sum(l_quantity) AS t FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey")
def segment_sums(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_quantity")
    return graphs.segment_sum(rows, "s_suppkey", "l_quantity", table(spark, sf_dir, "supplier").select("s_suppkey"), "received")


@query("""SELECT l_suppkey AS receiver, count(*) AS messages, round(sum(l_quantity * p_size + coalesce(s_acctbal, 0) / 100), 4) AS message FROM lineitem
LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""")
def message_passing(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    sent = graphs.gather(edges, table(spark, sf_dir, "part").withColumn("size", F.col("p_size").cast("double")), "l_partkey", "p_partkey", "size", 0.0, "sender")
    both = graphs.gather(sent, table(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", "s_acctbal", 0.0, "receiver_balance")
    message = F.col("l_quantity") * F.col("sender") + F.col("receiver_balance") / 100
    return both.groupBy(F.col("l_suppkey").alias("receiver")).agg(F.count(F.lit(1)).alias("messages"), F.round(F.sum(message), 4).alias("message"))


@query(f"""WITH {POINTS} SELECT a.vec_id, b.vec_id AS vertex_id, round(sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)), 6) AS distance FROM points a JOIN points b
ON b.vec_id % 10 = 0 AND abs(a.x-b.x) <= 0.2 AND sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) <= 0.2""")
def radius_neighbours(spark, sf_dir):
    p = points(spark, sf_dir)
    return graphs.within_radius(p, p.where("vec_id % 10 = 0"), 0.2).select("vec_id", "vertex_id", *_rounded("distance"))


@query("""SELECT unnest([l_partkey, l_suppkey, l_orderkey]) AS sender, unnest([l_suppkey, l_orderkey, l_partkey]) AS receiver FROM lineitem WHERE l_linenumber = 1""")
def face_edges(spark, sf_dir):
    faces = table(spark, sf_dir, "lineitem").where("l_linenumber = 1")
    return graphs.face_edges(faces, F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey"))


# The SQL of the three queries below is written for whole tables; radius_neighbours, face_edges and unpacked_variables keep the rows that their own SQL names.
@query(f"""WITH {POINTS} SELECT a.vec_id, b.vec_id AS vertex_id, round(sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)), 6) AS distance FROM points a JOIN points b
ON abs(a.x-b.x) <= 0.2 AND sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) <= 0.2""")
def all_radius_neighbours(spark, sf_dir):
    p = points(spark, sf_dir)
    return graphs.within_radius(p, p, 0.2).select("vec_id", "vertex_id", *_rounded("distance"))


@query("""SELECT unnest([l_partkey, l_suppkey, l_orderkey]) AS sender, unnest([l_suppkey, l_orderkey, l_partkey]) AS receiver FROM lineitem""")
def all_face_edges(spark, sf_dir):
    return graphs.face_edges(table(spark, sf_dir, "lineitem"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey"))


@query("SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity, max(l_tax) AS l_tax FROM lineitem GROUP BY 1, 2")
def all_unpacked_variables(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    return fields.unpacked(fields.packed(table(spark, sf_dir, "lineitem"), keys, ["l_quantity", "l_tax"], ""), keys, ["l_quantity", "l_tax"])


# ------------------------------------------------------------------ cyclones


@query(f"""WITH {FIELD}, b AS (SELECT floor((lat + 90) / 30)::BIGINT AS box_lat, floor(lon / 30)::BIGINT AS box_lon, value, lat, lon,
row_number() OVER (PARTITION BY floor((lat + 90) / 30), floor(lon / 30) ORDER BY value DESC, lat, lon) AS k FROM field WHERE NOT isnan(value))
SELECT box_lat, box_lon, value AS peak, lat, lon FROM b WHERE k = 1 AND value > 100""")
def cyclone_candidates(spark, sf_dir):
    return cyclones.candidates(field(spark, sf_dir).where(~F.isnan("value")), "value", 30.0, 100.0)


@query(f"""WITH {FIXES}, n AS (SELECT floor(avg(step))::BIGINT AS now FROM fixes)
SELECT track_id, step, lat, lon FROM fixes, n WHERE step BETWEEN now - 4 AND now AND track_id IN (SELECT track_id FROM fixes, n WHERE step = now)""")
def observed_lookback(spark, sf_dir):
    rows = fixes(spark, sf_dir)
    now = rows.agg(F.floor(F.avg("step")).cast("long").alias("now"))
    return cyclones.lookback(rows.join(F.broadcast(now)), F.col("now"), 4).select("track_id", "step", "lat", "lon")  # now is one row


@query(f"""WITH {FIXES}, p AS (SELECT *, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0 FROM fixes WINDOW w AS (PARTITION BY track_id ORDER BY step))
SELECT track_id, step, round({geo.DISTANCE.format(lat0='lat0', lon0='lon0', lat1='lat', lon1='lon')}, 3) AS moved_km FROM p WHERE lat0 IS NOT NULL""")
def track_motion(spark, sf_dir):
    return cyclones.motion(fixes(spark, sf_dir)).select("track_id", "step", F.round("moved_km", 3).alias("moved_km"))


@query(f"""WITH {STORMS} SELECT round(regr_slope(wind_b, wind_a), 6) AS slope, round(regr_intercept(wind_b, wind_a), 6) AS intercept, count(*) AS n FROM storms WHERE wind_b IS NOT NULL""")
def wind_calibration(spark, sf_dir):
    both = storms(spark, sf_dir).where("wind_b IS NOT NULL")
    return both.agg(F.round(F.regr_slope("wind_b", "wind_a"), 6).alias("slope"), F.round(F.regr_intercept("wind_b", "wind_a"), 6).alias("intercept"), F.count(F.lit(1)).alias("n"))


@query()
def imputed_radii(spark, sf_dir):
    radii, flag = cyclones.impute([F.col("r34").getItem(i) for i in range(4)], F.col("wind_a"), 34.0)
    return storms(spark, sf_dir).select("sid", "fix", *[r.alias(f"radius_{i}") for i, r in enumerate(radii)], flag.alias("flag"))


ORACLES["imputed_radii"] = f"""WITH {STORMS}, k AS (SELECT *, list_filter(r34, lambda r: r IS NOT NULL) AS known FROM storms)
SELECT sid, fix, """ + ", ".join(f"coalesce(r34[{i + 1}], CASE WHEN len(known) > 0 THEN list_sum(known) / len(known) ELSE 0.0 END) AS radius_{i}" for i in range(4)) + """,
CASE WHEN len(known) = 4 THEN 'present' WHEN len(known) > 0 THEN 'mean' WHEN wind_a >= 34 THEN 'zero' ELSE 'missing' END AS flag FROM k"""

_CLIP = "list_transform({r}, lambda r: CASE WHEN r IS NULL THEN NULL WHEN wind_a < {t} THEN 0.0 ELSE greatest(r, 0.0) END) AS {r}"
_QUADRANTS = [f"CASE WHEN r50[{i}] IS NULL THEN NULL ELSE greatest(r50[{i}], coalesce(r64[{i}], r50[{i}])) END" for i in (1, 2, 3, 4)]


@query(f"""WITH {STORMS}, a AS (SELECT sid, fix, wind_a, rmw, {_CLIP.format(r='r64', t=64)}, {_CLIP.format(r='r50', t=50)}, {_CLIP.format(r='r34', t=34)} FROM storms),
b AS (SELECT * REPLACE ([{', '.join(_QUADRANTS)}] AS r50) FROM a),
c AS (SELECT * REPLACE ([{', '.join(f'CASE WHEN r34[{i}] IS NULL THEN NULL ELSE greatest(r34[{i}], coalesce(r50[{i}], r34[{i}]), coalesce(r64[{i}], r34[{i}])) END' for i in (1, 2, 3, 4))}] AS r34) FROM b)
SELECT sid, fix, CASE WHEN rmw IS NOT NULL THEN least(rmw, CASE WHEN wind_a >= 64 THEN list_max(r64) END, CASE WHEN wind_a >= 50 THEN list_max(r50) END, CASE WHEN wind_a >= 34 THEN list_max(r34) END) END AS rmw,
{', '.join(f'r34[{i}] AS r34_{i}, r50[{i}] AS r50_{i}, r64[{i}] AS r64_{i}' for i in (1, 2, 3, 4))} FROM c""")
def consistent_storms(spark, sf_dir):
    found = cyclones.consistent(storms(spark, sf_dir))
    return found.select("sid", "fix", "rmw", *[F.col(r).getItem(i - 1).alias(f"{r}_{i}") for i in (1, 2, 3, 4) for r in ("r34", "r50", "r64")])


_GRID = "grid AS (SELECT (b * 10 - 90)::DOUBLE AS cell_lat, (c * 10)::DOUBLE AS cell_lon FROM range(0, 19) t(b), range(0, 36) u(c))"


@query(f"""WITH {FIXES}, {_GRID}, near AS (SELECT *, {geo.DISTANCE.format(lat0='cell_lat', lon0='cell_lon', lat1='lat', lon1='lon')} AS d FROM grid, fixes)
SELECT cell_lat, cell_lon, max(CASE WHEN d < 1000.0 THEN wind END) AS greatest, round(sum(exp(-d * d / (2 * 1000.0 * 1000.0))), 6) AS gaussian FROM near GROUP BY 1, 2""")
def disc_raster(spark, sf_dir):
    """The greatest wind of the discs that hold a cell, and the bumps of all fixes, however far."""
    rows = fixes(spark, sf_dir)
    bumps = cyclones.gaussian_raster(rows, 1000.0, 10.0)
    return bumps.join(cyclones.disc_raster(rows, "wind", 1000.0, 10.0), ["cell_lat", "cell_lon"], "left").select("cell_lat", "cell_lon", "greatest", *_rounded("gaussian"))


@query(f"""WITH {FIELD}, p AS (SELECT event_id, cos(radians(lat)) * cos(radians(lon)) AS x, cos(radians(lat)) * sin(radians(lon)) AS y, sin(radians(lat)) AS z, lat AS was FROM field WHERE abs(lat) < 90)
SELECT event_id, round(degrees(asin(z)), 6) + 0.0 AS lat, round((degrees(atan2(y, x)) + 360 + 1e-9) % 360, 6) + 0.0 AS lon FROM p""")
def positions_back(spark, sf_dir):
    rows = field(spark, sf_dir).where("abs(lat) < 90")
    x, y, z = geo.cartesian(F.col("lat"), F.col("lon"))
    lat, lon = geo.latlon(x, y, z)
    return rows.select("event_id", (F.round(lat, 6) + 0.0).alias("lat"), (F.round((lon + 1e-9) % 360, 6) + 0.0).alias("lon"))


# ------------------------------------------------------------------ campaign


@query("""SELECT o_orderdate AS init, bool_or(o_orderstatus = 'F') AS published FROM orders GROUP BY 1""")
def pending_inits(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("init"), "o_orderstatus")
    return campaign.pending(orders.select("init").distinct(), orders.where("o_orderstatus = 'F'"))


@query("""WITH i AS (SELECT DISTINCT o_orderdate AS init FROM orders) SELECT init, ntile(13) OVER (ORDER BY init)::INT AS block, ((row_number() OVER (ORDER BY init) - 1) % 13)::INT AS turn FROM i""")
def split_inits(spark, sf_dir):
    return campaign.split(table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("init")).distinct(), 13)


@query("""WITH y AS (SELECT DISTINCT year(o_orderdate)::BIGINT AS y FROM orders), d AS (SELECT unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY))::DATE AS init FROM y)
SELECT strftime(init, '%Y-%m-%d') AS init, init IN (SELECT o_orderdate::DATE FROM orders) AS ordered FROM d WHERE day(init) IN (1, 7, 9, 13, 17, 19, 25, 31)""")
def init_calendar(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("init")).distinct()
    years = days.agg(F.min(F.year("init")), F.max(F.year("init"))).first()
    return campaign.calendar(spark, years[0], years[1]).join(days.withColumn("ordered", F.lit(True)), "init", "left").select(F.date_format("init", "yyyy-MM-dd").alias("init"), F.coalesce("ordered", F.lit(False)).alias("ordered"))


@query("SELECT o_custkey % 50 AS member, round(quantile_cont(o_totalprice, 0.1), 4) AS p10, round(quantile_cont(o_totalprice, 0.9), 4) AS p90 FROM orders GROUP BY 1")
def member_percentiles(spark, sf_dir):
    """Quantiles from counts of equal values over sorted ranges."""
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("member"), "o_totalprice")
    return ordering.quantiles(rows, "member", "o_totalprice", {"p10": 0.1, "p90": 0.9}).select("member", F.round("p10", 4).alias("p10"), F.round("p90", 4).alias("p90"))


# ------------------------------------------------------------------ streams


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS variable, count(*) AS n, min(value) AS least, max(value) AS greatest FROM events GROUP BY 1, 2")
def streamed_days(spark, sf_dir):  # a pattern, for a stream takes no single file as a folder
    return daily.run_once(spark, f"{sf_dir}/events.parque[t]", table(spark, sf_dir, "events").schema)
