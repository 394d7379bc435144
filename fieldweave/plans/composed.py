"""Queries that put operators together: conditions and batches of models, member axes, losses, checks of tracks, stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cyclones, fields, graphs, meshes
from ..sources.tables import shared_folder
from ..sources.views import FIELD, FIXES, STORMS, field, fixes, points, storms, table
from ..streaming import writer
from . import campaign
from .registry import query


@query(f"""WITH {FIELD}, m AS (SELECT max(step) AS init FROM field)
SELECT event_id, variable, step, round(value::FLOAT::DOUBLE, 3) AS value FROM field, m WHERE step BETWEEN init - 1 AND init AND variable IN ('click', 'view', 'purchase') AND NOT isnan(value)""")
def initial_conditions(spark, sf_dir):
    """The two newest frames of some variables as floats; what may lack values is left out before."""
    rows = field(spark, sf_dir).where(~F.isnan("value"))
    newest = rows.agg(F.max("step").alias("init"))
    rows = field(spark, sf_dir).where(~F.isnan("value")).join(F.broadcast(newest))  # newest is one row
    found = fields.initial_conditions(rows, F.col("init"), ["click", "view", "purchase"])
    return found.select("event_id", "variable", "step", F.round(F.col("value").cast("double"), 3).alias("value"))


@query(f"""WITH {FIELD}, i AS (SELECT member, variable, step, max(value) AS value FROM field WHERE NOT isnan(value) GROUP BY 1, 2, 3), n AS (SELECT member, max(step) AS newest FROM i GROUP BY 1)
SELECT member, variable, step, value FROM i UNION ALL SELECT member, v, newest + k, 'NaN'::DOUBLE FROM n, (SELECT unnest(['click', 'view', 'rain']) AS v), range(1, 7) t(k)""")
def model_batch(spark, sf_dir):
    """Input frames and six frames of NaN behind them, one variable of which has no inputs."""
    rows = field(spark, sf_dir).where(~F.isnan("value")).groupBy("member", "variable", "step").agg(F.max("value").alias("value"))
    return fields.batch(rows, ["member"], 6, ["click", "view", "rain"])


@query(f"""WITH {FIELD}, m AS (SELECT floor(avg(step))::BIGINT AS t FROM field), r AS (SELECT event_id, variable, step, CASE WHEN step < t AND variable IN ('click', 'view') THEN 'input' WHEN step >= t AND variable IN ('click', 'purchase') THEN 'target' WHEN step >= t AND variable = 'view' THEN 'forcing' END AS role FROM field, m)
SELECT * FROM r WHERE role IS NOT NULL""")
def model_roles(spark, sf_dir):
    rows = field(spark, sf_dir)
    middle = rows.agg(F.floor(F.avg("step")).cast("long").alias("t"))
    return fields.roles(rows.join(F.broadcast(middle)), ["click", "view"], ["click", "purchase"], ["view"], F.col("t")).select("event_id", "variable", "step", "role")  # middle is one row


@query("""WITH v AS (SELECT DISTINCT event_type AS variable, event_type <> 'click' AS has_grid FROM events), r AS (SELECT *, unnest(['inputs', 'forcings']) AS role FROM v)
SELECT role, variable, CASE role WHEN 'inputs' THEN 'in_' ELSE 'forced_' END || variable AS name, CASE WHEN variable = 'view' THEN 'conditioning' WHEN has_grid THEN 'grid' ELSE 'global' END AS place FROM r""")
def routed_variables(spark, sf_dir):
    names = table(spark, sf_dir, "events").select(F.col("event_type").alias("variable")).distinct().withColumn("has_grid", F.col("variable") != "click")
    both = names.withColumn("role", F.explode(F.array(F.lit("inputs"), F.lit("forcings"))))
    return fields.routed(both, ["view"], {"inputs": "in_", "forcings": "forced_"})


@query("SELECT l_orderkey, l_linenumber, l_quantity::FLOAT AS l_quantity, l_extendedprice::FLOAT AS l_extendedprice FROM lineitem")
def cast_fields(spark, sf_dir):
    return fields.cast_floats(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), "float")


@query(f"WITH {FIELD} SELECT event_id, member, step FROM field WHERE member BETWEEN 2 AND 4")
def member_rows(spark, sf_dir):
    return fields.member_slice(field(spark, sf_dir), "member", 2, 5).select("event_id", "member", "step")


@query("SELECT l_orderkey AS batch, l_linenumber, m AS member, l_orderkey * 4 + m AS row, l_quantity FROM lineitem, range(0, 4) t(m)")
def members_as_batch(spark, sf_dir):
    """Four members of each row; batch and member as one axis, and back."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("batch"), "l_linenumber", "l_quantity")
    stacked = fields.stacked_axes(fields.with_members(rows, "member", 4), "batch", "member", 4, "row")
    return fields.unstacked_axes(stacked.withColumn("kept", F.col("row")), "row", 4, "batch", "member").withColumnRenamed("kept", "row")


@query("""WITH l AS (SELECT l_returnflag AS variable, avg(pow(l_quantity - l_tax * 100, 2)) AS loss FROM lineitem GROUP BY 1) SELECT round(sum(loss * CASE variable WHEN 'A' THEN 0.5 WHEN 'R' THEN 2.0 ELSE 1.0 END), 4) AS total, count(*) AS variables FROM l""")
def total_loss(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("variable"), F.col("l_quantity").alias("prediction"), (F.col("l_tax") * 100).alias("target"))
    return fields.total_loss(fields.losses(rows, 0.0, {}), {"A": 0.5, "R": 2.0}).select(F.round("total", 4).alias("total"), "variables")


_LEVELS = [80.0, 20.0, 5.0, 1.0, 0.25, 0.0]


def _sampler_sql(levels: list[float]) -> str:
    """The solver over the levels, a common table a step; the denoiser shrinks a value by 1 / (1 + noise * noise)."""
    parts, name = [], "s0"
    for i, (now, after) in enumerate(zip(levels, levels[1:], strict=False)):
        middle = (now * after) ** 0.5
        clean = f"x / (1 + {now!r}::DOUBLE * {now!r})"
        if after:
            half = f"(x * {middle / now!r}::DOUBLE + {clean} * {1 - middle / now!r}::DOUBLE)"
            new = f"x * {after / now!r}::DOUBLE + {half} / (1 + {middle!r}::DOUBLE * {middle!r}) * {1 - after / now!r}::DOUBLE"
        else:
            new = clean
        parts.append(f"s{i + 1} AS (SELECT event_id, {new} AS x FROM {name})")
        name = f"s{i + 1}"
    return f"WITH s0 AS (SELECT event_id, value AS x FROM events), {', '.join(parts)} SELECT event_id, round(x, 6) AS sample FROM {name}"


@query(_sampler_sql(_LEVELS))
def sampled_values(spark, sf_dir):
    found = fields.sampled(table(spark, sf_dir, "events").select("event_id", "value"), _LEVELS, lambda x, noise: x / (1 + noise * noise), "value")
    return found.select("event_id", F.round("sample", 6).alias("sample"))


@query("SELECT DISTINCT o_orderdate AS init FROM orders WHERE month(o_orderdate) NOT IN (1, 2, 12)")
def kept_months(spark, sf_dir):
    return campaign.filter_months(table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("init")).distinct(), [1, 2, 12])


@query(f"WITH {FIXES} SELECT count(CASE WHEN track_id % 7 = 0 AND step % 4 = 0 THEN 1 END) AS incomplete, count(*) AS rows FROM fixes, (SELECT min(step) AS a FROM fixes) WHERE step <> a")
def incomplete_tracks(spark, sf_dir):
    rows = fixes(spark, sf_dir)
    first = rows.agg(F.min("step").alias("a"))
    wind = F.when((F.col("track_id") % 7 == 0) & (F.col("step") % 4 == 0), F.lit(float("nan"))).otherwise(F.col("wind"))
    return cyclones.nan_tracks(rows.withColumn("wind", wind).join(F.broadcast(first)).withColumn("lead", F.col("step") - F.col("a")), ["lat", "lon", "wind"], "lead")  # first is one row


def _up(a: str, *bs: str) -> str:
    return f"CASE WHEN {a} IS NOT NULL THEN greatest({', '.join([a, *bs])}) END"


def _enforced_sql(mode: str) -> str:
    """Each rule as a common table over plain columns."""
    q = (1, 2, 3, 4)
    flat = ", ".join(f"{r}[{i}] AS {r}_{i}" for r in ("r64", "r50", "r34") for i in q)
    clip = ", ".join(f"CASE WHEN {r}_{i} IS NOT NULL THEN CASE WHEN wind_a < {r[1:]} THEN 0.0 ELSE greatest({r}_{i}, 0.0) END END AS {r}_{i}" for r in ("r64", "r50", "r34") for i in q)
    rise = lambda src, to: f"{to}a AS (SELECT * REPLACE ({', '.join(f'{_up(f'r50_{i}', f'r64_{i}')} AS r50_{i}' for i in q)}) FROM {src}), {to} AS (SELECT * REPLACE ({', '.join(f'{_up(f'r34_{i}', f'r50_{i}', f'r64_{i}')} AS r34_{i}' for i in q)}) FROM {to}a)"
    top = lambda r: f"greatest({', '.join(f'{r}_{i}' for i in q)})"
    parts = [f"a AS (SELECT sid, fix, greatest(wind_a, 0.0) AS wind_a, CASE WHEN rmw IS NOT NULL THEN greatest(rmw, 0.0) END AS rmw, {flat} FROM storms)", f"b AS (SELECT * REPLACE ({clip}) FROM a)", rise("b", "c")]
    if mode == "clip_rmw":
        parts.append(f"d AS (SELECT * REPLACE (CASE WHEN rmw IS NOT NULL THEN least(rmw, {', '.join(f'CASE WHEN wind_a >= {r[1:]} THEN {top(r)} END' for r in ('r64', 'r50', 'r34'))}) END AS rmw) FROM c)")
    else:
        first = lambda r, i: " AND ".join([f"{r}_{i} = {top(r)}", *[f"{r}_{j} IS DISTINCT FROM {top(r)}" for j in range(1, i)]])
        raised = ", ".join(f"CASE WHEN wind_a >= {r[1:]} AND {first(r, i)} THEN greatest({r}_{i}, rmw) ELSE {r}_{i} END AS {r}_{i}" for r in ("r64", "r50", "r34") for i in q)
        parts += [f"e AS (SELECT * REPLACE ({raised}) FROM c)", rise("e", "d")]
    return f"WITH {STORMS}, {', '.join(parts)} SELECT sid, fix, rmw, r34_1, r34_4, r50_2, r64_3, true AS radii_agree FROM d"


def _enforced(spark, sf_dir, mode):
    found = cyclones.enforced(storms(spark, sf_dir), mode)
    at = lambda r, i: F.col(r).getItem(i - 1).alias(f"{r}_{i}")
    return found.select("sid", "fix", "rmw", at("r34", 1), at("r34", 4), at("r50", 2), at("r64", 3), "radii_agree")


@query(_enforced_sql("clip_rmw"))
def enforced_by_clipping(spark, sf_dir):
    return _enforced(spark, sf_dir, "clip_rmw")


@query(_enforced_sql("raise_radii"))
def enforced_by_raising(spark, sf_dir):
    return _enforced(spark, sf_dir, "raise_radii")


@query(f"""WITH {FIXES}, f AS (SELECT step, greatest(-90.0, least(90.0, lat + (track_id % 3) * 0.05)) AS lat, lon, wind + (track_id % 2) * 0.01 AS wind FROM fixes WHERE track_id % 11 <> 0),
t AS (SELECT row_number() OVER () AS k, * FROM fixes), n AS (SELECT t.step, t.k, bool_or(abs(t.wind - f.wind) <= 0.001) AS ok FROM t JOIN f ON t.step = f.step AND {"2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians(f.lat - t.lat) / 2), 2) + cos(radians(t.lat)) * cos(radians(f.lat)) * pow(sin(radians(f.lon - t.lon) / 2), 2))))"} <= 20 GROUP BY 1, 2)
SELECT step, truth_rows, coalesce(found_rows, 0) AS found_rows, coalesce(near, 0) AS near, coalesce(agreeing, 0) AS agreeing FROM (SELECT step, count(*) AS truth_rows FROM fixes GROUP BY 1)
LEFT JOIN (SELECT step, count(*) AS found_rows FROM f GROUP BY 1) USING (step) LEFT JOIN (SELECT step, count(*) AS near, count(CASE WHEN ok THEN 1 END) AS agreeing FROM n GROUP BY 1) USING (step)""")
def compared_tracks(spark, sf_dir):
    """Fixes against copies of which some are moved, changed or left out."""
    rows = fixes(spark, sf_dir)
    lat = F.greatest(F.lit(-90.0), F.least(F.lit(90.0), F.col("lat") + F.col("track_id") % 3 * 0.05))
    found = rows.where("track_id % 11 <> 0").select("step", lat.alias("lat"), "lon", (F.col("wind") + F.col("track_id") % 2 * 0.01).alias("wind"))
    return cyclones.compared(rows, found, 20.0, ["wind"], 0.001)


@query("""WITH g AS (SELECT l_orderkey, l_partkey AS sender, l_suppkey AS receiver, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
p AS (SELECT *, (n + 3) // 4 * 4 AS k FROM g), a AS (SELECT l_orderkey, CASE WHEN n > 1 THEN i * (k - 1) // (n - 1) ELSE 0 END AS slot, sender, receiver FROM p),
s AS (SELECT l_orderkey, unnest(range(0, k)) AS slot FROM (SELECT DISTINCT l_orderkey, k FROM p)) SELECT l_orderkey, slot::INT AS slot, coalesce(sender, -1) AS sender, coalesce(receiver, -1) AS receiver FROM s LEFT JOIN a USING (l_orderkey, slot)""")
def spread_edges(spark, sf_dir):
    edges = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("sender"), F.col("l_suppkey").alias("receiver"))
    return graphs.padded_edges(edges, "l_orderkey", ["l_linenumber", "sender", "receiver"], 4, spread=True)


@query("""WITH n AS (SELECT p_brand AS graph, sum(p_size) AS node_sum, count(*) AS nodes FROM part GROUP BY 1), e AS (SELECT p_brand AS graph, sum(l_quantity) AS edge_sum, count(*) AS edges FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT graph, node_sum::BIGINT AS node_sum, nodes, coalesce(edge_sum, 0) AS edge_sum, coalesce(edges, 0) AS edges FROM n LEFT JOIN e USING (graph)""")
def brand_globals(spark, sf_dir):
    """Sums of a graph's nodes and edges, a graph a brand."""
    nodes = table(spark, sf_dir, "part").select(F.col("p_brand").alias("graph"), "p_partkey", "p_size")
    edges = table(spark, sf_dir, "lineitem").join(nodes.select("graph", F.col("p_partkey").alias("l_partkey")), "l_partkey")
    return graphs.global_sums(nodes, edges, "graph", "p_size", "l_quantity")


@query("""WITH e AS (SELECT p_partkey AS node, p_size::DOUBLE AS f FROM part), g AS (SELECT l_partkey AS sender, l_suppkey AS receiver, l_tax AS w FROM lineitem),
a AS (SELECT e.node, f * 0.5 + coalesce(s, 0) AS f FROM e LEFT JOIN (SELECT receiver AS node, sum((x.f - y.f) * w) AS s FROM g JOIN e x ON sender = x.node JOIN e y ON receiver = y.node GROUP BY 1) t USING (node)),
b AS (SELECT a.node, f * 0.5 + coalesce(s, 0) AS f FROM a LEFT JOIN (SELECT receiver AS node, sum((x.f - y.f) * w) AS s FROM g JOIN a x ON sender = x.node JOIN a y ON receiver = y.node GROUP BY 1) t USING (node))
SELECT node AS p_partkey, round(f, 4) AS f FROM b""")
def two_rounds(spark, sf_dir):
    """Two rounds of message passing."""
    nodes = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("f"))
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("sender"), F.col("l_suppkey").alias("receiver"), F.col("l_tax").alias("w"))
    found = graphs.network(nodes, edges, "p_partkey", "f", "w", 2, lambda s, r, w: (s - r) * w, lambda f, total: f * 0.5 + total)
    return found.select("p_partkey", F.round("f", 4).alias("f"))


@query()
def grid_to_mesh(spark, sf_dir):
    """The edges of a model's encoder and decoder between the points and a mesh of two splits, by graph."""
    found = meshes.model_graphs(points(spark, sf_dir), 2)
    return found["grid2mesh"].select(F.lit("grid2mesh").alias("graph"), "sender", "receiver").unionByName(found["mesh2grid"].select(F.lit("mesh2grid").alias("graph"), "sender", "receiver"))


@query()
def featured_edges(spark, sf_dir):
    """The edges of a model's three graphs over the points and a mesh of two splits, by receiver, with their features, padded to 64s."""
    _, edges = meshes.featured_graphs(points(spark, sf_dir), 2, multiple=64)
    parts = [(F.round(F.col("features")[i], 6) + 0.0).alias(c) for i, c in enumerate(("length", "dx", "dy", "dz"))]
    return edges.select("graph", "slot", "sender", "receiver", *parts)


@query(f"WITH {FIELD} SELECT member, variable, (floor((step - 1) / 4))::BIGINT AS day, count(DISTINCT step) AS steps, round(avg(value), 6) AS daily_mean, round(max(value), 6) AS daily_greatest FROM field WHERE NOT isnan(value) GROUP BY 1, 2, 3 HAVING count(DISTINCT step) = 4")
def stored_forecast(spark, sf_dir):
    """Members written in groups of two into a store, published, and its daily folds read."""
    rows = field(spark, sf_dir).where(~F.isnan("value")).select("member", "variable", "step", "value")
    store = writer.ForecastStore(spark, shared_folder(spark, "forecast"), 8)
    for number in range(4):
        store.write_batch(rows.where(F.col("member").between(2 * number, 2 * number + 1)), number)
    store.publish([])
    return store.daily().select("member", "variable", "day", "steps", F.round("daily_mean", 6).alias("daily_mean"), F.round("daily_greatest", 6).alias("daily_greatest"))


@query(f"""WITH {FIELD} SELECT event_id, (TIMESTAMP '2024-01-01 00:00:00' + to_hours((step * 6)::INT))::VARCHAR AS valid, ['first', 'second'][member // 4 + 1] AS model FROM field WHERE variable <> 'click'""")
def merged_forecast(spark, sf_dir):
    """Two chunks as one forecast, with valid times and the models of members, without one variable."""
    rows = field(spark, sf_dir)
    out = writer.merged([rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")], "2024-01-01 00:00:00", ["first", "second"], 4, "click")
    return out.select("event_id", F.date_format("valid", "yyyy-MM-dd HH:mm:ss").alias("valid"), "model")
