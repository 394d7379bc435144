"""Queries about samplers, masks of walks, attention in blocks, and rollouts of models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import noise
from ..operators import cyclones, fields, graphs, intervals, models, spheres
from ..sources import chunks
from ..sources.tables import shared_folder, ship
from ..sources.views import FIELD, FIXES, STORMS, field, field_of, fixes, micros, storms, table
from ..streaming import daily
from .composed import _sampler_sql
from .registry import query

#: The schedule of a sampler of 20 levels, and its churn.
LEVELS = [round(v, 6) for v in fields.noise_levels(80.0, 0.03, 20, 7.0)]
RATES = fields.churn_rates(LEVELS, 2.5, 0.75, 80.0)


def _shrunk(x, level):
    """The expected value of standard normal data seen through noise."""
    return x / (1 + level * level)


@query(_sampler_sql(LEVELS))
def deep_sampled_values(spark, sf_dir):
    """20 levels, without churn."""
    found = fields.sampled(table(spark, sf_dir, "events").select("event_id", "value"), LEVELS, _shrunk, "value")
    return found.select("event_id", F.round("sample", 6).alias("sample"))


@query()
def churned_values(spark, sf_dir):
    """20 levels with churn, from isotropic noise on the sphere that belongs to the member and the level."""
    ship(spark)
    rows = field(spark, sf_dir).select("event_id", "member", "lat", "lon")
    power = [1 / 16] * 16
    draws = F.array(*[noise.isotropic(F.col("lat"), F.col("lon"), noise.key_of(11, F.col("member"), F.lit(i)), power) for i in range(len(LEVELS))])
    return fields.sampled(rows, LEVELS, _shrunk, None, RATES, draws, 1.05).select("event_id", F.round("sample", 6).alias("sample"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS sender, l_suppkey + l_linenumber * l_linenumber AS receiver FROM lineitem),
walks AS (SELECT DISTINCT v AS sender, v AS receiver, 0 AS hops FROM (SELECT sender AS v FROM e UNION SELECT receiver FROM e)
UNION SELECT w.sender, e.receiver, w.hops + 1 FROM walks w JOIN e ON w.receiver = e.sender WHERE w.hops < 3)
SELECT sender, receiver, min(hops)::INT AS hops FROM walks GROUP BY 1, 2""")
def k_hop_pairs(spark, sf_dir):
    """Pairs of nodes at most three edges apart, in a graph whose edges are short."""
    receiver = F.col("l_suppkey") + F.col("l_linenumber") * F.col("l_linenumber")
    return graphs.k_hop(table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("sender"), receiver.alias("receiver")), 3)


#: Nodes of a block.
BLOCK = 64


@query("""WITH n AS (SELECT vec_id AS node, list_transform(embedding[1:4], lambda x: x::DOUBLE) AS q, list_transform(embedding[5:8], lambda x: x::DOUBLE) AS k, list_transform(embedding[9:10], lambda x: x::DOUBLE) AS v FROM embeddings),
x AS (SELECT r.node AS receiver, s.v, list_dot_product(r.q, s.k) / 2 AS logit FROM n r JOIN n s ON s.node BETWEEN r.node - 5 AND r.node + 5),
w AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY receiver)) AS w FROM x)
SELECT receiver, count(*) AS edges, round(sum(w * v[1]) / sum(w), 6) AS first, round(sum(w * v[2]) / sum(w), 6) AS second FROM w GROUP BY 1""")
def banded_attention(spark, sf_dir):
    """Each vector attends to those whose numbers are within five of its own, in blocks."""
    part = lambda a, n: F.transform(F.slice("embedding", a, n), lambda x: x.cast("double"))
    rows = table(spark, sf_dir, "embeddings")
    nodes = rows.select(F.col("vec_id").alias("node"), part(1, 4).alias("q"), part(5, 4).alias("k"), part(9, 2).alias("v"))
    beside = rows.select(F.col("vec_id").alias("receiver"), F.explode(F.sequence(F.lit(-5), F.lit(5))).alias("d"))
    edges = beside.select((F.col("receiver") + F.col("d")).alias("sender"), "receiver").where("sender >= 0")
    found = graphs.block_attention(nodes, edges, BLOCK)
    return found.select("receiver", "edges", *[(F.round(F.col("attended")[i], 6) + 0.0).alias(c) for i, c in enumerate(("first", "second"))])


def _linear(inputs, forcings, step):
    """A model of two channels that mix, driven by one forcing."""
    newest, before = inputs[:, 1], inputs[:, 0]
    return 0.5 * newest + 0.2 * before + 0.1 * newest[:, ::-1] + forcings * step


@query(f"""WITH RECURSIVE {FIELD}, c AS (SELECT member, step, max(CASE WHEN variable = 'view' THEN value END) AS a, max(CASE WHEN variable = 'click' THEN value END) AS b
  FROM field WHERE NOT isnan(value) AND variable IN ('view', 'click') GROUP BY 1, 2),
l AS (SELECT *, row_number() OVER (PARTITION BY member ORDER BY step DESC) AS age FROM c),
w AS (SELECT n.member, 0 AS lead, n.a, n.b, p.a AS pa, p.b AS pb FROM l n JOIN l p ON n.member = p.member AND n.age = 1 AND p.age = 2
  UNION ALL SELECT member, lead + 1, 0.5 * a + 0.2 * pa + 0.1 * b + member * (lead + 1), 0.5 * b + 0.2 * pb + 0.1 * a + member * (lead + 1), a, b FROM w WHERE lead < 6)
SELECT member, lead, round(a, 6) AS view, round(b, 6) AS click FROM w WHERE lead > 0 AND a IS NOT NULL AND b IS NOT NULL""")
def model_rollout(spark, sf_dir):
    """Six leads of a model over stacked channels, four at a time, each chunk a table."""
    rows = field(spark, sf_dir).where(~F.isnan("value"))
    inputs = models.stacked(rows, ["member"], "step", ["view", "click"], 2)
    forcings = inputs.select("member", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("lead")).withColumn("forcings", F.array(F.col("member").cast("double")))
    found = models.Rollout(shared_folder(spark, "rollout"), _linear, ["member"], 4).run(inputs, 6, forcings)
    out = found.select("member", "lead", *[F.round(F.col("channels")[i], 6).alias(c) for i, c in enumerate(("view", "click"))])
    return out.where(~F.isnan("view") & ~F.isnan("click"))


_YEAR = "year(DATE '1970-01-01' + floor({} / 4.0)::INT)"


@query(f"""WITH {FIXES}, inits AS (SELECT DISTINCT step AS init FROM fixes WHERE step % 4 = 0)
SELECT f.track_id, f.step, i.init, f.lat, f.lon FROM fixes f JOIN inits i ON f.step BETWEEN i.init - 12 AND i.init AND abs({_YEAR.format("f.step")} - {_YEAR.format("i.init")}) <= 1
WHERE EXISTS (SELECT 1 FROM fixes g WHERE g.track_id = f.track_id AND g.step = i.init)""")
def storms_around_inits(spark, sf_dir):
    """Three days of the tracks that have a fix at exactly an initial time, for all initial times."""
    rows = fixes(spark, sf_dir)
    inits = rows.where(F.col("step") % 4 == 0).select(F.col("step").alias("init")).distinct()
    return intervals.storms_around(rows.select("track_id", "step", "lat", "lon"), inits, 12).select("track_id", "step", "init", "lat", "lon")


@query(f"""WITH {FIXES}, inits AS (SELECT DISTINCT step AS init FROM fixes WHERE step % 4 = 0)
SELECT i.init, count(*) AS fixes, max(f.wind) AS wind FROM fixes f JOIN inits i ON f.step BETWEEN i.init - 2 AND i.init + 5 GROUP BY 1""")
def fixes_around_inits(spark, sf_dir):
    """All fixes from half a day before to a day and a quarter after each initial time."""
    rows = fixes(spark, sf_dir)
    inits = rows.where(F.col("step") % 4 == 0).select(F.col("step").alias("init")).distinct()
    return intervals.around(rows, inits, 2, 5).groupBy("init").agg(F.count(F.lit(1)).alias("fixes"), F.max("wind").alias("wind"))


@query(f"""WITH {FIELD} SELECT member, variable, (floor((step - 1) / 4))::BIGINT AS day, count(DISTINCT step) AS steps, CASE WHEN bool_or(isnan(value)) THEN NULL ELSE round(sum(value), 4) END AS daily_sum,
  CASE WHEN bool_or(isnan(value)) THEN NULL ELSE max(value) END AS daily_greatest FROM field GROUP BY 1, 2, 3 HAVING count(DISTINCT step) = 4""")
def streamed_whole_days(spark, sf_dir):
    """The days of a member and variable, once a stream has brought their four steps."""
    schema = table(spark, sf_dir, "events").schema
    stream = field_of(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")).select("member", "variable", "step", "value")
    store = daily.DailyStore(spark, shared_folder(spark, "days"), ["member", "variable"])
    store.run(stream)
    return store.days().select("member", "variable", "day", "steps", F.round("daily_sum", 4).alias("daily_sum"), "daily_greatest")


@query()
def noise_grids(spark, sf_dir):
    """The noise field of each member and variable on a grid of 5 degrees."""
    ship(spark)
    keys = field(spark, sf_dir).select("member", "variable").distinct().withColumn("key", noise.key_of(5, F.col("member"), F.col("variable")))
    out = noise.isotropic_grid(keys, "key", [5.0 * i - 90 for i in range(37)], [5.0 * i for i in range(72)], [1 / 24] * 24)
    return out.select("member", "variable", "lat", "lon", F.round("noise", 6).alias("noise"))


@query(f"WITH {FIELD} SELECT event_id, member, step, lat, value FROM field WHERE member BETWEEN 2 AND 4 AND step >= (SELECT min(step) + 30 FROM field) AND NOT isnan(value)")
def chunk_box(spark, sf_dir):
    """A box of members and steps, read from a store of chunks that holds the whole field."""
    rows, path = field(spark, sf_dir), shared_folder(spark, "chunks")
    first = rows.agg(F.min("step")).first()[0]
    chunks.write_chunks(rows.select("event_id", "member", "step", "lat", "value"), path, {"member": 2, "step": 16}, {"member": 4, "step": 64})
    return chunks.read_chunks(spark, path).where(F.col("member").between(2, 4) & (F.col("step") >= (first or 0) + 30) & ~F.isnan("value"))


@query(f"""WITH {FIELD}, have AS (SELECT DISTINCT variable, step FROM field WHERE member = 3), inits AS (SELECT DISTINCT step AS init FROM field WHERE step % 2 = 0), ends AS (SELECT max(step) - 8 AS final FROM field),
need AS (SELECT init, v AS variable, init - d AS step FROM inits, (VALUES ('view'), ('click'), ('signup')) t(v), (VALUES (0), (1)) u(d))
SELECT init, variable, step, 'missing' AS reason FROM need ANTI JOIN have USING (variable, step)
UNION ALL SELECT init, 'orography', -1, 'missing' FROM inits UNION ALL SELECT init, '', -1, 'preliminary' FROM inits, ends WHERE init > final""")
def missing_inputs(spark, sf_dir):
    """What one member's record lacks for each initial time: frames, a static variable, the final form of the last two days."""
    rows = field(spark, sf_dir)
    inits = rows.where(F.col("step") % 2 == 0).select(F.col("step").alias("init"))
    last = rows.agg(F.max("step")).first()[0] or 0
    return fields.missing_inputs(rows.where("member = 3"), inits, ["view", "click", "signup"], statics=("orography",), last=last, final=last - 8).select("init", F.coalesce("variable", F.lit("")).alias("variable"), F.coalesce("step", F.lit(-1)).alias("step"), "reason")


_YEARS = "(epoch_us(ts) / 1000000.0 / (365.24219 * 86400))"


@query(f"""SELECT event_id, value AS day_progress, round({_YEARS} - floor({_YEARS}), 6) AS year_progress, round(sin(2 * pi() * {_YEARS}), 6) + 0.0 AS year_progress_sin, round(cos(2 * pi() * {_YEARS}), 6) + 0.0 AS year_progress_cos FROM events""")
def derived_progress(spark, sf_dir):
    """Variables that derive from time, where they are wanted and not there."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("value").alias("day_progress"), (micros(F.col("ts")) / 1e6).alias("_seconds"), F.lit(0.0).alias("_lon"))
    wanted = ["day_progress", "year_progress", "year_progress_sin", "year_progress_cos", "value"]
    out = fields.with_derived(rows, wanted, F.col("_seconds"), F.col("_lon"))
    return out.select("event_id", "day_progress", *[(F.round(c, 6) + 0.0).alias(c) for c in wanted[1:4]])


@query(f"""WITH {FIXES}, grid AS (SELECT (r * 10 - 90)::DOUBLE AS cell_lat, (c * 10)::DOUBLE AS cell_lon FROM range(0, 19) a(r), range(0, 36) b(c)),
n AS (SELECT round((lat + 90) / 10) * 10 - 90 AS cell_lat, (round(lon / 10) * 10) % 360 AS cell_lon, count(*) AS n FROM fixes GROUP BY 1, 2)
SELECT cell_lat, cell_lon, coalesce(n, 0) AS fixes FROM grid LEFT JOIN n USING (cell_lat, cell_lon)""")
def fixes_of_cells(spark, sf_dir):
    """How many fixes each cell of a whole grid has, empty cells among them."""
    near = fixes(spark, sf_dir).groupBy((F.round((F.col("lat") + 90) / 10) * 10 - 90).alias("cell_lat"), (F.round(F.col("lon") / 10) * 10 % 360).alias("cell_lon")).agg(F.count(F.lit(1)).alias("n"))
    return spheres.grid_cells(spark, 10.0).join(near, ["cell_lat", "cell_lon"], "left").select("cell_lat", "cell_lon", F.coalesce("n", F.lit(0)).alias("fixes"))


def _falls(strong: str, weak: str) -> str:
    return " AND ".join(f"coalesce({strong}[{i}] <= {weak}[{i}], true)" for i in (1, 2, 3, 4))


@query(f"""WITH {STORMS} SELECT sid, fix, {_falls("r64", "r50")} AND {_falls("r50", "r34")} AND {_falls("r64", "r34")}
  AND {" AND ".join(f"coalesce(wind_a < {t} OR rmw <= list_max({r}), true)" for r, t in (("r64", 64), ("r50", 50), ("r34", 34)))} AS radii_agree FROM storms""")
def checked_radii(spark, sf_dir):
    """Whether storms obey physics as they are; many do not."""
    return cyclones.checked(storms(spark, sf_dir)).select("sid", "fix", "radii_agree")
