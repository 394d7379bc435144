"""Tables, and views that give them the shapes of fields, tracks, storms, graphs and campaigns.

Each view has a DuckDB twin in SQL with the same columns; keys use whole-number arithmetic so that both agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEP_US, DAY_US = 21_600_000_000, 86_400_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def field_of(events: DataFrame) -> DataFrame:
    """Members' values of variables on a grid; `step` is the 6-hour step that ends at or after the event; some values are NaN."""
    step = F.ceil(micros(F.col("ts")) / STEP_US).cast("long")
    return events.select(
        "event_id", (F.col("user_id") % 8).alias("member"), F.col("event_type").alias("variable"), step.alias("step"),
        (F.col("user_id") * 37 % 181 - 90).cast("double").alias("lat"), (F.col("event_id") * 53 % 360).cast("double").alias("lon"),
        F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )


def field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_of(table(spark, sf_dir, "events"))


FIELD = """field AS (SELECT event_id, user_id % 8 AS member, event_type AS variable, ceil(epoch_us(ts) / 21600000000)::BIGINT AS step,
  (user_id * 37 % 181 - 90)::DOUBLE AS lat, (event_id * 53 % 360)::DOUBLE AS lon,
  CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE ELSE value END AS value FROM events)"""


def fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One position and wind a track and 6-hour step."""
    e = table(spark, sf_dir, "events")
    step = F.ceil(micros(F.col("ts")) / STEP_US).cast("long")
    return e.groupBy(F.col("user_id").alias("track_id"), step.alias("step")).agg(
        F.max(F.col("user_id") * 37 % 141 - 70 + F.col("event_id") % 3).cast("double").alias("lat"),
        F.max(F.col("event_id") * 53 % 360).cast("double").alias("lon"), F.max("value").alias("wind"),
    )


FIXES = """fixes AS (SELECT user_id AS track_id, ceil(epoch_us(ts) / 21600000000)::BIGINT AS step, max(user_id * 37 % 141 - 70 + event_id % 3)::DOUBLE AS lat,
  max(event_id * 53 % 360)::DOUBLE AS lon, max(value) AS wind FROM events GROUP BY 1, 2)"""


def storms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixes of storms: winds of two agencies, radius of maximum wind and quadrant radii of three thresholds, some unknown."""
    q, m = F.col("l_quantity"), F.col("l_partkey") % 7
    radius = lambda k: F.array(*[F.when((F.col("l_suppkey") + i) % 5 == 0, F.lit(None).cast("double")).otherwise((F.col("l_partkey") * (i + 3) % 200 - k).cast("double")) for i in range(4)])
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sid"), F.col("l_linenumber").alias("fix"), (q * 2).alias("wind_a"), F.when(m != 0, q * 1.75 + F.floor(F.col("l_discount") * 100)).alias("wind_b"),
        (F.col("l_suppkey") % 90).cast("double").alias("rmw"), radius(10).alias("r34"), radius(40).alias("r50"), radius(70).alias("r64"),
    )


def _radius(k: int) -> str:
    return "[" + ", ".join(f"CASE WHEN (l_suppkey + {i}) % 5 = 0 THEN NULL ELSE (l_partkey * {i + 3} % 200 - {k})::DOUBLE END" for i in range(4)) + "]"


STORMS = f"""storms AS (SELECT l_orderkey AS sid, l_linenumber AS fix, l_quantity * 2 AS wind_a, CASE WHEN l_partkey % 7 <> 0 THEN l_quantity * 1.75 + floor(l_discount * 100) END AS wind_b,
  (l_suppkey % 90)::DOUBLE AS rmw, {_radius(10)} AS r34, {_radius(40)} AS r50, {_radius(70)} AS r64 FROM lineitem)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points on the unit sphere: the first three components of each vector, to 4 digits, renormalised."""
    x = [F.round(F.element_at("embedding", i).cast("double"), 4) for i in (1, 2, 3)]
    raw = table(spark, sf_dir, "embeddings").select("vec_id", *[c.alias(n) for c, n in zip(x, "xyz", strict=True)])
    norm = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    return raw.where(norm > 0).select("vec_id", *[(F.col(c) / norm).alias(c) for c in "xyz"])


POINTS = """raw AS (SELECT vec_id, round(embedding[1]::DOUBLE, 4) AS x, round(embedding[2]::DOUBLE, 4) AS y, round(embedding[3]::DOUBLE, 4) AS z FROM embeddings),
points AS (SELECT vec_id, x / sqrt(x*x + y*y + z*z) AS x, y / sqrt(x*x + y*y + z*z) AS y, z / sqrt(x*x + y*y + z*z) AS z FROM raw WHERE x*x + y*y + z*z > 0)"""
