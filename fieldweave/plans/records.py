"""Queries about layouts of stores, stacked fields, rollouts, schedules, graphs' bookkeeping, names and texts of campaigns."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import cyclones, fields, graphs, ordering
from ..sources.views import FIELD, FIXES, field, fixes, table
from . import campaign
from .registry import query

# ------------------------------------------------------------------ stacked and rolled fields


@query(f"""WITH {FIELD}, c AS (SELECT member, step, variable, round(max(value), 6) AS v FROM field WHERE NOT isnan(value) GROUP BY 1, 2, 3)
SELECT member, step, count(*) AS channels, string_agg(variable, ',' ORDER BY variable) AS names, round(list_sum(list(v ORDER BY variable)), 4) AS total, arg_min(v, variable) AS first_value FROM c GROUP BY 1, 2""")
def stacked_channels(spark, sf_dir):
    rows = field(spark, sf_dir).where(~F.isnan("value")).groupBy("member", "step", "variable").agg(F.round(F.max("value"), 6).alias("value"))
    out = fields.stacked(rows, ["member", "step"], "variable", "value")
    total = F.aggregate("channel_values", F.lit(0.0), lambda s, x: s + x)
    return out.select("member", "step", F.size("channels").cast("long").alias("channels"), F.array_join("channels", ",").alias("names"), F.round(total, 4).alias("total"), F.element_at("channel_values", 1).alias("first_value"))


@query("SELECT l_orderkey, l_linenumber, unnest(['l_discount', 'l_quantity', 'l_tax']) AS variable, unnest([l_discount, l_quantity, l_tax]) AS value FROM lineitem")
def unstacked_channels(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    rows = fields.packed(table(spark, sf_dir, "lineitem"), keys, ["l_quantity", "l_discount", "l_tax"], "")
    return fields.unstacked(fields.stacked(rows, keys, "variable", "value"), keys, "variable", "value")


@query(f"""WITH {FIELD}, m AS (SELECT variable, max(step) AS newest FROM field GROUP BY 1), l AS (SELECT event_id, variable, step - newest + 8 AS lead FROM field JOIN m USING (variable))
SELECT event_id, variable, lead, CASE WHEN lead <= 0 THEN 'input' ELSE 'target' END AS role FROM l WHERE lead > -2 AND (lead <= 0 OR lead BETWEEN 1 AND 8)""")
def input_target_times(spark, sf_dir):
    """The last input has lead 0; inputs lie in (-2, 0], targets in [1, 8]."""
    return fields.input_targets(field(spark, sf_dir), ["variable"], 2, 8).select("event_id", "variable", "lead", "role")


@query(f"""WITH {FIELD}, s AS (SELECT variable, stddev_pop(value) AS sd FROM field WHERE NOT isnan(value) GROUP BY 1), l AS (SELECT member, variable, arg_max(value, event_id) AS last FROM field WHERE NOT isnan(value) GROUP BY 1, 2)
SELECT event_id, variable, round((value - last) / sd, 6) + 0.0 AS residual, round((value - last) / sd * sd + last, 6) AS restored FROM field JOIN s USING (variable) JOIN l USING (member, variable) WHERE NOT isnan(value)""")
def residual_targets(spark, sf_dir):
    rows = field(spark, sf_dir).where(~F.isnan("value"))
    last = rows.groupBy("member", "variable").agg(F.max_by("value", "event_id").alias("last"))
    spread = fields.statistics(rows).select("variable", "std")
    out = fields.to_residuals(rows, last, spread, ["member", "variable"])
    return fields.from_residuals(out).select("event_id", "variable", (F.round("residual", 6) + 0.0).alias("residual"), F.round("restored", 6).alias("restored"))


@query(f"""WITH {FIELD}, f AS (SELECT *, max(isnan(value)::INT) OVER (PARTITION BY member, variable, lat) AS hit FROM field)
SELECT event_id, CASE WHEN hit = 1 THEN 'NaN'::DOUBLE ELSE value END AS value, hit = 1 AS was_nan FROM f""")
def nan_restored(spark, sf_dir):
    """NaN comes back wherever one frame of the cell had it."""
    rows = field(spark, sf_dir)
    hit = rows.groupBy("member", "variable", "lat").agg(F.max(F.isnan("value")).alias("was_nan"))
    out = rows.join(hit, ["member", "variable", "lat"])
    return out.select("event_id", F.when(F.col("was_nan"), F.lit(float("nan"))).otherwise(F.col("value")).alias("value"), "was_nan")


@query(f"""WITH RECURSIVE {FIELD}, o AS (SELECT member, variable, value, row_number() OVER (PARTITION BY member, variable ORDER BY event_id DESC) AS k FROM field WHERE NOT isnan(value)),
b AS (SELECT member, variable, max(CASE WHEN k = 1 THEN value END) AS x1, max(CASE WHEN k = 2 THEN value END) AS x0 FROM o WHERE k <= 2 GROUP BY 1, 2),
r AS (SELECT member, variable, 0 AS lead, x1, x0 FROM b WHERE x0 IS NOT NULL UNION ALL SELECT member, variable, lead + 1, 0.7 * x1 + 0.2 * x0, x1 FROM r WHERE lead < 10)
SELECT member, variable, lead, round(x1, 6) AS value FROM r WHERE lead > 0""")
def rolled_out(spark, sf_dir):
    rows = field(spark, sf_dir).where(~F.isnan("value"))
    out = fields.rollout(rows, ["member", "variable"], "event_id", 10, lambda new, old: new * 0.7 + old * 0.2)
    return out.select("member", "variable", "lead", F.round("value", 6).alias("value"))


@query(f"""WITH {FIELD}, l AS (SELECT member, variable, max(step) AS newest FROM field GROUP BY 1, 2) SELECT member, variable, newest + k AS step, (k + 3) // 4 AS chunk, 'NaN'::DOUBLE AS value FROM l, range(1, 11) t(k)""")
def extended_template(spark, sf_dir):
    """Ten lazy target frames behind each newest one, in chunks of four."""
    newest = field(spark, sf_dir).groupBy("member", "variable").agg(F.max("step").alias("newest"))
    rows = newest.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(10).cast("long"))))
    return rows.select("member", "variable", (F.col("newest") + F.col("k")).alias("step"), F.expr("(k + 3) div 4").alias("chunk"), F.lit(float("nan")).alias("value"))


@query("""WITH n AS (SELECT event_id, value, pow(pow(80.0, 1 / 7.0) + (event_id % 20) / 19.0 * (pow(0.03, 1 / 7.0) - pow(80.0, 1 / 7.0)), 7) AS s FROM events)
SELECT event_id, round(s, 6) AS noise, CASE WHEN s BETWEEN 0.75 AND 50 THEN least(2.5 / 20, sqrt(2.0) - 1) ELSE 0.0 END AS churn, round(1 / sqrt(s * s + 1), 6) AS c_in, round(s / sqrt(s * s + 1), 6) AS c_out,
round(1 / (s * s + 1), 6) AS c_skip, round((s * s + 1) / (s * s), 4) AS weight FROM n""")
def noise_levels(spark, sf_dir):
    level = fields.noise_level(F.col("event_id") % 20 / 19.0, 80.0, 0.03, 7.0)
    rows = table(spark, sf_dir, "events").select("event_id", level.alias("s"))
    c = fields.preconditioning(F.col("s"))
    return rows.select("event_id", F.round("s", 6).alias("noise"), fields.churn(F.col("s"), 2.5, 20, 0.75, 50.0).alias("churn"), *[F.round(v, 4 if n == "weight" else 6).alias(n) for n, v in c.items()])


@query("""SELECT event_id, round(1 / (1 + exp(-value / 100)), 6) AS sigmoid, round(greatest(value - 50, 0), 6) AS relu, round(value / 100 / (1 + exp(-value / 100)), 6) AS swish, round(2 / (1 + exp(-(value / 100 + 1))), 6) AS shifted FROM events""")
def activations(spark, sf_dir):
    v = F.col("value") / 100
    sigmoid = lambda x: 1 / (1 + F.exp(-x))
    columns = {"sigmoid": sigmoid(v), "relu": F.greatest(F.col("value") - 50, F.lit(0.0)), "swish": v * sigmoid(v), "shifted": 2 * sigmoid(v + 1)}
    return table(spark, sf_dir, "events").select("event_id", *[F.round(c, 6).alias(n) for n, c in columns.items()])


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 10 AND l_linenumber <> 3 THEN l_extendedprice ELSE 0.0 END AS masked FROM lineitem")
def masked_points(spark, sf_dir):
    """A mask of two axes, joined only where it is used."""
    valid = (F.col("l_quantity") > 10) & (F.col("l_linenumber") != 3)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(valid, F.col("l_extendedprice")).otherwise(0.0).alias("masked"))


@query("""SELECT l_returnflag AS variable, count(*) AS n, round(avg(CASE WHEN l_linenumber % 3 = 0 THEN 2.0 ELSE pow(l_quantity - l_tax * 100, 2) END), 6) AS loss,
round(avg(CASE WHEN l_linenumber % 3 = 0 THEN 2.0 ELSE pow(l_quantity - l_tax * 100, 2) END) * CASE l_returnflag WHEN 'A' THEN 0.5 ELSE 1 END, 6) AS weighted FROM lineitem GROUP BY 1""")
def variable_losses(spark, sf_dir):
    """Targets that are NaN (every third line here) count with a fill loss; variables weigh by a table, others 1."""
    target = F.when(F.col("l_linenumber") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("l_tax") * 100)
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("variable"), F.col("l_quantity").alias("prediction"), target.alias("target"))
    out = fields.losses(rows, 2.0, {"A": 0.5})
    return out.select("variable", "n", F.round("loss", 6).alias("loss"), F.round("weighted", 6).alias("weighted"))


@query(f"WITH {FIELD} SELECT variable, quantile_cont(value, 0.02) AS low, quantile_cont(value, 0.98) AS high, greatest(abs(quantile_cont(value, 0.02)), abs(quantile_cont(value, 0.98))) AS reach FROM field WHERE NOT isnan(value) GROUP BY 1")
def robust_scales(spark, sf_dir):
    found = ordering.quantiles(field(spark, sf_dir).where(~F.isnan("value")), "variable", "value", {"low": 0.02, "high": 0.98})
    return found.withColumn("reach", F.greatest(F.abs("low"), F.abs("high")))


# ------------------------------------------------------------------ tracks


@query(f"WITH {FIXES} SELECT track_id, min(step) AS first_step, max(step) AS last_step, count(*) AS fixes, min((lon + 180) % 360 - 180) AS west, max((lon + 180) % 360 - 180) AS east FROM fixes GROUP BY 1")
def storm_spans(spark, sf_dir):
    lon = F.pmod(F.col("lon") + 180, F.lit(360.0)) - 180
    return fixes(spark, sf_dir).groupBy("track_id").agg(F.min("step").alias("first_step"), F.max("step").alias("last_step"), F.count(F.lit(1)).alias("fixes"), F.min(lon).alias("west"), F.max(lon).alias("east"))


@query(f"""WITH {FIXES}, s AS (SELECT track_id, min(step) AS a, max(step) AS b FROM fixes GROUP BY 1), n AS (SELECT floor(avg(step))::BIGINT AS now FROM fixes)
SELECT track_id, now - a AS age, round(lat, 6) AS lat, round(lon, 6) AS lon FROM s JOIN n ON now BETWEEN a AND b JOIN fixes USING (track_id) WHERE step = now""")
def time_slice(spark, sf_dir):
    """Tracks whose span covers the moment and that have a fix then."""
    rows = fixes(spark, sf_dir)
    now = rows.agg(F.floor(F.avg("step")).cast("long").alias("now"))
    spans = rows.groupBy("track_id").agg(F.min("step").alias("a"), F.max("step").alias("b"))
    at = rows.join(F.broadcast(now), F.col("step") == F.col("now"))  # now is one row
    return at.join(spans, "track_id").where("now between a and b").select("track_id", (F.col("now") - F.col("a")).alias("age"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query(f"""WITH {FIXES}, b AS (SELECT min(lat) AS la, max(lat) AS lb, min(lon) AS oa, max(lon) AS ob FROM fixes) SELECT track_id, step, round((lat - la) / (lb - la) * 255, 6) AS pixel_row, round((lon - oa) / (ob - oa) * 511, 6) AS pixel_column FROM fixes, b""")
def pixel_positions(spark, sf_dir):
    rows = fixes(spark, sf_dir)
    ends = rows.agg(F.min("lat").alias("la"), F.max("lat").alias("lb"), F.min("lon").alias("oa"), F.max("lon").alias("ob"))
    scaled = lambda c, a, b, n: F.round((F.col(c) - F.col(a)) / (F.col(b) - F.col(a)) * n, 6)
    return rows.join(F.broadcast(ends)).select("track_id", "step", scaled("lat", "la", "lb", 255).alias("pixel_row"), scaled("lon", "oa", "ob", 511).alias("pixel_column"))  # one row of ends


@query(f"""WITH {FIXES}, o AS (SELECT *, 'cyclogenesis_' || track_id AS name FROM fixes), d AS (SELECT name FROM o GROUP BY 1 HAVING max(step) - min(step) > 10)
SELECT replace(name, 'cyclogenesis_', '') AS track, step, (step - min(step) OVER ())::BIGINT * 6 AS lead_hours FROM o WHERE name IN (SELECT name FROM d)""")
def lasting_tracks(spark, sf_dir):
    """Tracks of more than 2.5 days (10 steps), with lead times from the first frame of all."""
    rows = fixes(spark, sf_dir).withColumn("name", F.concat(F.lit("cyclogenesis_"), F.col("track_id").cast("string")))
    long_ones = rows.groupBy("name").agg((F.max("step") - F.min("step")).alias("span")).where("span > 10")
    kept = rows.join(long_ones, "name", "left_semi")
    first = kept.agg(F.min("step").alias("first"))
    return kept.join(F.broadcast(first)).select(F.replace("name", F.lit("cyclogenesis_"), F.lit("")).alias("track"), "step", ((F.col("step") - F.col("first")) * 6).alias("lead_hours"))  # first is one row


@query(f"""WITH {FIXES} SELECT a.track_id, a.step, bool_or(b.wind > a.wind) AS outranked, count(b.track_id) AS nearby FROM fixes a LEFT JOIN fixes b ON a.step = b.step AND a.track_id <> b.track_id
AND {geo.DISTANCE.format(lat0='a.lat', lon0='a.lon', lat1='b.lat', lon1='b.lon')} < 2000 GROUP BY 1, 2""")
def nearby_tracks(spark, sf_dir):
    return cyclones.nearby(fixes(spark, sf_dir), 2000.0)


# ------------------------------------------------------------------ graphs


_GRAPH = "g AS (SELECT l_partkey AS sender, l_suppkey AS receiver, l_quantity AS w, l_orderkey, l_linenumber FROM lineitem)"


def _graph(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("sender"), F.col("l_suppkey").alias("receiver"), F.col("l_quantity").alias("w"), "l_orderkey", "l_linenumber")


@query(f"WITH {_GRAPH} SELECT sender, receiver FROM g UNION SELECT sender, sender FROM g UNION SELECT receiver, receiver FROM g")
def adjacency(spark, sf_dir):
    return graphs.adjacency(_graph(spark, sf_dir), "sender", "receiver", self_edges=True)


@query(f"WITH {_GRAPH} SELECT sender // 8 AS row, receiver // 8 - sender // 8 AS side, count(*) AS entries FROM g WHERE abs(receiver // 8 - sender // 8) <= 1 GROUP BY 1, 2")
def block_diagonals(spark, sf_dir):
    return graphs.block_diagonals(_graph(spark, sf_dir), 8)


@query(f"WITH {_GRAPH} SELECT max(abs(sender - receiver)) + 1 AS bandwidth, count(*) AS edges, sum(w) AS total FROM g")
def graph_globals(spark, sf_dir):
    return _graph(spark, sf_dir).agg((F.max(F.abs(F.col("sender") - F.col("receiver"))) + 1).alias("bandwidth"), F.count(F.lit(1)).alias("edges"), F.sum("w").alias("total"))


@query(f"""WITH {_GRAPH} SELECT p_partkey, p_retailprice, coalesce(r, 0.0) AS received, coalesce(s, 0.0) AS sent FROM part LEFT JOIN (SELECT receiver, sum(w) AS r FROM g GROUP BY 1) ON p_partkey = receiver
LEFT JOIN (SELECT sender, sum(w) AS s FROM g GROUP BY 1) ON p_partkey = sender""")
def node_updates(spark, sf_dir):
    return graphs.node_update(table(spark, sf_dir, "part"), _graph(spark, sf_dir), "p_partkey", "p_retailprice", "w")


@query(f"""WITH {_GRAPH}, n AS (SELECT l_orderkey, sender, receiver, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, sender, receiver) - 1 AS slot, count(*) OVER (PARTITION BY l_orderkey) AS n FROM g)
SELECT l_orderkey, slot::INT AS slot, sender, receiver FROM n UNION ALL SELECT l_orderkey, unnest(range(n, (n + 3) // 4 * 4))::INT, -1, -1 FROM (SELECT DISTINCT l_orderkey, n FROM n)""")
def padded_edges(spark, sf_dir):
    return graphs.padded_edges(_graph(spark, sf_dir), "l_orderkey", ["l_linenumber", "sender", "receiver"], 4)


@query(f"""WITH {_GRAPH}, d AS (SELECT l_orderkey, sender, sender - lag(sender) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, sender) AS d FROM g)
SELECT l_orderkey, coalesce(bool_and(d >= 0), true) AS is_sorted, coalesce(max(d) = min(d), true) AS uniform, min(sender) >= 0 AND max(sender) < 150 AS in_range, bool_and(sender // 50 = 0) AS stays_local FROM d GROUP BY 1""")
def index_checks(spark, sf_dir):
    before = F.lag("sender").over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "sender"))
    d = _graph(spark, sf_dir).withColumn("d", F.col("sender") - before)
    truth = lambda c: F.coalesce(c, F.lit(True))
    return d.groupBy("l_orderkey").agg(truth(F.min("d") >= 0).alias("is_sorted"), truth(F.max("d") == F.min("d")).alias("uniform"), ((F.min("sender") >= 0) & (F.max("sender") < 150)).alias("in_range"), F.bool_and(F.expr("sender div 50 = 0")).alias("stays_local"))


# ------------------------------------------------------------------ campaign


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H') || '.zarr' AS store, strftime(o_orderdate, '%Y-%m-%dT%H') || '.zarr_partial' AS staged FROM orders""")
def store_paths(spark, sf_dir):
    store = campaign.store_path(F.col("o_orderdate"), ".zarr")
    return table(spark, sf_dir, "orders").select("o_orderkey", store.alias("store"), F.concat(store, F.lit("_partial")).alias("staged"))


@query("""WITH t AS (SELECT o_orderkey AS k, (o_orderkey % 24)::VARCHAR AS h, (o_orderkey % 59)::VARCHAR AS m FROM orders)
SELECT k AS o_orderkey, CASE k % 6 WHEN 0 THEN (k % 59) * 60 WHEN 1 THEN (k % 24) * 60 + k % 59 WHEN 2 THEN (k % 24) * 3600 + (k % 59) * 60 + 7 WHEN 3 THEN 2 * 86400 + (k % 24) * 3600 WHEN 4 THEN 86400 + (k % 24) * 3600 + (k % 59) * 60 ELSE 3 * 86400 + (k % 24) * 3600 + (k % 59) * 60 + 9 END AS seconds FROM t""")
def time_limits(spark, sf_dir):
    k = F.col("o_orderkey")
    h, m = (k % 24).cast("string"), (k % 59).cast("string")
    texts = [m, F.concat_ws(":", h, m), F.concat_ws(":", h, m, F.lit("07")), F.concat(F.lit("2-"), h), F.concat(F.lit("1-"), F.concat_ws(":", h, m)), F.concat(F.lit("3-"), F.concat_ws(":", h, m, F.lit("09")))]
    text = F.element_at(F.array(*texts), (k % 6 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", campaign.limit_seconds(text).alias("seconds"))


@query("""WITH d AS (SELECT DISTINCT o_custkey, o_orderdate::DATE AS d FROM orders), l AS (SELECT o_custkey, list(strftime(d, '%Y-%m-%d') ORDER BY d) AS l FROM d GROUP BY 1)
SELECT o_custkey, CASE WHEN len(l) <= 6 THEN array_to_string(l, ', ') ELSE l[1] || ' ... ' || l[-1] || ' (' || len(l) || ')' END AS dates FROM l""")
def date_summaries(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    return campaign.summaries(days, "o_custkey", "day", 6)


@query("""WITH p AS (SELECT o_orderkey, 'source-' || o_orderpriority || '_res-' || (o_orderkey % 3) || '_levels-' || (o_orderkey % 2 * 24 + 13) AS name FROM orders),
q AS (SELECT o_orderkey, map_from_entries(list_transform(string_split(name, '_'), lambda x: {'k': split_part(x, '-', 1), 'v': regexp_replace(x, '^[^-]*-', '')})) AS m FROM p)
SELECT o_orderkey, m['source'] AS source, m['res'] AS res, m['levels'] AS levels FROM q WHERE m['res'] = '1' AND m['levels'] = '13'""")
def file_parts(spark, sf_dir):
    k = F.col("o_orderkey")
    name = F.concat(F.lit("source-"), F.col("o_orderpriority"), F.lit("_res-"), (k % 3).cast("string"), F.lit("_levels-"), (k % 2 * 24 + 13).cast("string"))
    parts = table(spark, sf_dir, "orders").select("o_orderkey", campaign.file_parts(name).alias("parts"))
    chosen = parts.where((F.col("parts")["res"] == "1") & (F.col("parts")["levels"] == "13"))
    return chosen.select("o_orderkey", F.col("parts")["source"].alias("source"), F.col("parts")["res"].alias("res"), F.col("parts")["levels"].alias("levels"))


@query("""WITH i AS (SELECT o_orderdate AS init, bool_or(o_orderstatus = 'F') AS published, bool_or(o_orderstatus = 'P') AS staged, bool_or(o_orderpriority LIKE '1%') AS claimed FROM orders GROUP BY 1)
SELECT init, CASE WHEN published THEN 'published' WHEN claimed THEN 'claimed' WHEN staged THEN 'staged' ELSE 'pending' END AS state FROM i""")
def init_states(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "init")
    return campaign.states(orders.select("init").distinct(), {"published": orders.where("o_orderstatus = 'F'"), "claimed": orders.where("o_orderpriority like '1%'"), "staged": orders.where("o_orderstatus = 'P'")})


@query("""SELECT init FROM (SELECT o_orderdate AS init, bool_or(o_orderstatus = 'F') AS published FROM orders GROUP BY 1) WHERE NOT published ORDER BY init LIMIT 20""")
def next_inits(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("init"), "o_orderstatus")
    done = orders.where("o_orderstatus = 'F'")
    return campaign.pending(orders.select("init").distinct(), done).where(~F.col("published")).select("init").orderBy("init").limit(20)


@query("""WITH b AS (SELECT event_type AS variable, (event_id // 250)::BIGINT AS shard, (event_id // 50)::BIGINT AS chunk, sum(length(props)) AS nbytes FROM events GROUP BY 1, 2, 3)
SELECT variable, shard, chunk, nbytes::BIGINT AS nbytes, (sum(nbytes) OVER (PARTITION BY variable, shard ORDER BY chunk) - nbytes)::BIGINT AS first_byte FROM b""")
def shard_index(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("variable"), "event_id", F.length("props").alias("size"))
    return fields.shard_index(rows, "variable", "event_id", "size", 50, 250)


# Bytes of one field on a grid of a quarter degree, and the published seconds of a start, of an init outside its
# rollout, and of one step of a group of members.
FIELD_BYTES = 721 * 1440 * 4
START_SECONDS, INIT_SECONDS, STEP_SECONDS = 260, 80, 3.73


@query(f"SELECT p_type AS variable, sum(p_size * {FIELD_BYTES}) AS store_bytes, {START_SECONDS} + count(*) * (sum(p_size) / 4.0 * {STEP_SECONDS} + {INIT_SECONDS}) AS seconds FROM part GROUP BY 1")
def store_sizes(spark, sf_dir):
    parts = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("variable"))
    size = F.sum(F.col("p_size").cast("long") * FIELD_BYTES).cast("double")
    return parts.agg(size.alias("store_bytes"), (START_SECONDS + F.count(F.lit(1)) * (F.sum("p_size") / 4.0 * STEP_SECONDS + INIT_SECONDS)).alias("seconds"))


@query("""WITH n AS (SELECT DISTINCT o_custkey AS run, (o_orderkey % 5 + 1)::INT AS k FROM orders), f AS (SELECT run, min(c)::INT AS free FROM (SELECT DISTINCT run FROM n) r, range(1, 7) t(c) WHERE NOT EXISTS (SELECT 1 FROM n m WHERE m.run = r.run AND m.k = c) GROUP BY 1)
SELECT run, CASE WHEN free = 1 THEN 'run' ELSE 'run_' || free END AS name FROM f""")
def free_run_names(spark, sf_dir):
    taken = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run"), (F.col("o_orderkey") % 5 + 1).cast("int").alias("k"))
    return campaign.free_names(taken, "run", "k", "run")
