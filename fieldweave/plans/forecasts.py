"""Queries about whole forecasts and tracks that come as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import shared_folder
from ..sources.views import DAY_US, micros, table
from ..streaming import forecast, tracks
from .geometry import SCALARS, TRACKING, _tracking_grid
from .registry import query

#: Days of a frame of the record, and the leads of its forecast.
FRAME_DAYS, LEADS = 5, 8


def _record(spark, sf_dir):
    """Mean values of four sites and a variable in frames of five days, and a static height of each site."""
    e = table(spark, sf_dir, "events")
    step = F.floor(micros(F.col("ts")) / (FRAME_DAYS * DAY_US)).cast("long")
    site = (F.col("user_id") % 4).cast("long")
    means = e.groupBy(F.col("event_type").alias("variable"), step.alias("step"), site.alias("site")).agg((F.avg("value") / 7).alias("value"))
    heights = e.select(F.lit("height").alias("variable"), F.lit(0).cast("long").alias("step"), site.alias("site")).distinct().withColumn("value", (F.col("site") + 1) / 11)
    return means.unionByName(heights)


def _first(inputs, forced, lead):
    return 0.5 * inputs[:, 1] + 0.2 * inputs[:, 0] + 0.1 * inputs[:, 1, ::-1] + forced.sum(axis=1, keepdims=True)


def _second(inputs, forced, lead):
    return 0.4 * inputs[:, 1] + 0.3 * inputs[:, 0] + forced[:, :1] * lead - forced[:, 1:]


_DAY = "((w.lead + 1) * 0.25 - floor((w.lead + 1) * 0.25))"


@query(f"""WITH RECURSIVE r AS (SELECT event_type AS variable, floor(epoch_us(ts) / {FRAME_DAYS * DAY_US})::BIGINT AS step, user_id % 4 AS site, (avg(value) / 7)::FLOAT::DOUBLE AS value FROM events GROUP BY 1, 2, 3),
m AS (SELECT max(step) AS init FROM r), c AS (SELECT site, step, max(CASE WHEN variable = 'view' THEN value END) AS a, max(CASE WHEN variable = 'click' THEN value END) AS b FROM r GROUP BY 1, 2),
w AS (SELECT t.member, n.site, 0 AS lead, n.a, n.b, p.a AS pa, p.b AS pb FROM m JOIN c n ON n.step = init JOIN c p ON p.site = n.site AND p.step = init - 1, range(0, 6) t(member)
  UNION ALL SELECT member, site, lead + 1, CASE WHEN member < 3 THEN 0.5 * a + 0.2 * pa + 0.1 * b + (site + 1) / 11 + {_DAY} ELSE 0.4 * a + 0.3 * pa + (site + 1) / 11 * (lead + 1) - {_DAY} END,
    CASE WHEN member < 3 THEN 0.5 * b + 0.2 * pb + 0.1 * a + (site + 1) / 11 + {_DAY} ELSE 0.4 * b + 0.3 * pb + (site + 1) / 11 * (lead + 1) - {_DAY} END, a, b FROM w WHERE lead < {LEADS}),
v AS (SELECT member, site, lead, 'view' AS variable, a AS value FROM w UNION ALL SELECT member, site, lead, 'click', b FROM w)
SELECT member, site, variable, lead AS step, strftime(TIMESTAMP '2024-01-31 00:00:00' + to_hours((lead * 6)::INT), '%Y-%m-%d %H:%M:%S') AS valid, CASE WHEN member < 3 THEN 'first' ELSE 'second' END AS model, round(value, 6) AS value FROM v WHERE lead > 0""")
def whole_forecast(spark, sf_dir):
    """Six members of two models from the record's newest frames (floats), in groups of two at most, with a static and a derived forcing."""
    record, path = _record(spark, sf_dir), shared_folder(spark, "whole_forecast")
    init = record.where("variable <> 'height'").agg(F.max("step")).first()[0]
    task = forecast.Task(("view", "click"), ("site",), statics=("height",), derived=("day_progress",))
    forecast.Forecast(task, {"first": _first, "second": _second}, 3, group=2).run(record, init, "2024-01-31 00:00:00", LEADS, path)
    out = forecast.published(spark, path)
    return out.select("member", "site", "variable", "step", F.date_format("valid", "yyyy-MM-dd HH:mm:ss").alias("valid"), "model", F.round("value", 6).alias("value"))


@query()
def streamed_tracks(spark, sf_dir):
    """The tracks of `tracked_cyclones` from a stream whose files bring the frames' cells in no order; scalars as they are."""
    folder = shared_folder(spark, "frames")
    frames = tracks.framed(_tracking_grid(spark, sf_dir), None, list(SCALARS))
    frames.repartition(8, F.xxhash64("cell_lat", "cell_lon", "step")).write.parquet(folder)
    stream = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 3).parquet(folder)
    store = tracks.TrackStore(spark, shared_folder(spark, "tracks"), TRACKING, list(SCALARS))
    store.run(stream)
    names = ("lat", "lon", *SCALARS)
    return store.tracks().select("run", "track", "step", F.round("existence", 6).alias("existence"), "merged_into", *[(F.round(c, 4) + 0.0).alias(c) for c in names])
