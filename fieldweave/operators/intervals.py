"""Joins of spans and moments, and the storms around initial times, for all of them in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A moment's year, of a number of 6-hour steps since 1970.
STEPS_A_DAY = 4


def spans_at(spans: DataFrame, moments: DataFrame, first: str, last: str, at: str, bucket: int, on: tuple[str, ...] = ()) -> DataFrame:
    """spans x moments with first <= at <= last, and equal `on`: spans are cut into buckets of time, so that rows meet by
    bucket and each pair meets once, in the bucket of the moment. A span without an end, or a null moment, meets nothing.

    A span is sent once for each bucket that it touches: take a bucket about as wide as spans are long."""
    number = lambda c: F.floor(F.col(c) / bucket).cast("long")
    cut = spans.where(F.col(first) <= F.col(last)).withColumn("_bucket", F.explode(F.sequence(number(first), number(last))))
    met = cut.join(moments.withColumn("_bucket", number(at)), [*on, "_bucket"]).drop("_bucket")
    return met.where(F.col(at).between(F.col(first), F.col(last)))


def _year(step: Column) -> Column:
    return F.year(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(step / STEPS_A_DAY).cast("int")))


def storms_around(fixes: DataFrame, inits: DataFrame, lookback: int, years: int = 1, bucket: int | None = None) -> DataFrame:
    """For each init (a step): the fixes of the `lookback` steps up to it of tracks that have a fix at exactly that step, of
    the years from `years` before the init's to `years` after it. All columns of fixes (track_id, step ...) and `init`.

    Tracks are found alive as spans that hold an init; their windows then meet the fixes as spans of their own. No init
    costs a job, and a track's fixes are not compared with all inits."""
    width = bucket or max(1, lookback)
    lives = fixes.groupBy("track_id").agg(F.min("step").alias("_first"), F.max("step").alias("_last"))
    alive = spans_at(lives, inits.select("init").distinct(), "_first", "_last", "init", width).select("track_id", "init")
    exact = alive.join(fixes.select("track_id", F.col("step").alias("init")).distinct(), ["track_id", "init"])
    windows = exact.select("track_id", "init", (F.col("init") - lookback).alias("_from"))
    rows = spans_at(windows, fixes, "_from", "init", "step", width, ("track_id",)).drop("_from")
    return rows.where(F.abs(_year(F.col("step")) - _year(F.col("init"))) <= years)


def around(fixes: DataFrame, inits: DataFrame, before: int, after: int, bucket: int | None = None) -> DataFrame:
    """For each init: all fixes from `before` steps before it to `after` steps after it, whatever their tracks."""
    windows = inits.select("init").distinct().select("init", (F.col("init") - before).alias("_from"), (F.col("init") + after).alias("_upto"))
    return spans_at(windows, fixes, "_from", "_upto", "step", bucket or max(1, before + after)).drop("_from", "_upto")
