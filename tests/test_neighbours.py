"""Counts of near places against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldweave.operators import cyclones, spheres
from test_gridding import km


@pytest.mark.parametrize("radius", [15.0, 2000.0, 30000.0])
def test_nearby_against_all_pairs(spark, radius):
    """Crowded places, poles, the meridian, unknown winds, tracks and positions."""
    draw = np.random.default_rng(3)
    lat = np.where(draw.random(300) < 0.3, draw.integers(-2, 2, 300) * 45.0, draw.uniform(-90, 90, 300))
    lon = np.where(draw.random(300) < 0.3, draw.integers(0, 4, 300) * 90.0, draw.uniform(-3, 363, 300) % 360)
    rows = [(None if i == 7 else i, i % 2, None if i == 20 else float(lat[i]), float(lon[i]), None if i % 5 == 0 else float("nan") if i == 33 else float(i * 7 % 50)) for i in range(300)]
    found = {(r["track_id"], r["step"]): (r["outranked"], r["nearby"]) for r in cyclones.nearby(spark.createDataFrame(rows, "track_id long, step long, lat double, lon double, wind double"), radius).collect()}
    assert len(found) == len(rows)
    more = lambda a, b: not math.isnan(b) and (math.isnan(a) or a > b)
    for t, s, y, x, w in rows:
        near = [r for r in rows if None not in (t, y, r[0], r[2]) and r[0] != t and r[1] == s and km(y, x, r[2], r[3]) < radius]
        winds = [r[4] for r in near if r[4] is not None]
        assert found[t, s] == (None if w is None or not winds else any(more(v, w) for v in winds), len(near))


def test_crowds_make_no_row_a_pair(spark):
    """20,000 fixes close together are 200 million pairs; the places they lie at are few, or cells count as a whole."""
    crowd = spark.range(20000).select(F.col("id").alias("track_id"), F.lit(1).alias("step"), (F.col("id") % 100 * 0.01).alias("lat"), (F.col("id") * 0.0001).alias("lon"), F.col("id").cast("double").alias("wind"))
    found = cyclones.nearby(crowd, 2000.0)
    assert found.agg(F.min("nearby"), F.max("nearby"), F.count_if("outranked")).first()[:] == (19999, 19999, 19999)


def test_reached_cubes_leave_out_none(spark):
    draw = np.random.default_rng(5)
    points = [(i, float(a), float(o)) for i, (a, o) in enumerate(zip(np.degrees(np.arcsin(draw.uniform(-1, 1, 150))), draw.uniform(0, 360, 150), strict=True))]
    table = spark.createDataFrame(points, "id long, lat double, lon double")
    for side in (0.2, 1.0):
        sent = spheres.reached_cubes(table, side, 800.0)
        own = table.select(F.col("id").alias("other"), *[c.alias(n) for n, c in spheres.cube(F.col("lat"), F.col("lon"), side).items()])
        met = {(r["id"], r["other"]) for r in sent.join(own, ["_cx", "_cy", "_cz"]).collect()}
        assert {(i, j) for i, a, o in points for j, b, p in points if km(a, o, b, p) <= 800} <= met
    assert sent.count() < 4 * len(points)


@pytest.mark.parametrize("scalars, tolerance", [([], 0.0), (["wind"], 0.0), (["wind", "rmw"], 0.5)])
def test_compared_against_all_pairs(spark, scalars, tolerance):
    draw = np.random.default_rng(8)
    odd = [None, float("nan"), float("inf"), 3.0, 3.5, 3.5000001, -0.5]
    rows = lambda: [(i % 2, float(draw.integers(-9, 9) * 0.1 + (89.5 if i < 40 else 0)), float(draw.integers(-9, 9) * 0.1 % 360), odd[draw.integers(0, 7)], odd[draw.integers(0, 7)]) for i in range(150)]
    truth, other = rows(), rows()
    frame = lambda r: spark.createDataFrame(r, "step int, lat double, lon double, wind double, rmw double")
    truth, other = ([(s, min(y, 90.0), x, w, m) for s, y, x, w, m in r] for r in (truth, other))
    found = {r["step"]: r[1:] for r in cyclones.compared(frame(truth), frame(other), 20.0, scalars, tolerance).collect()}
    alike = lambda a, b: a is b is None or (None not in (a, b) and abs(a - b) <= tolerance)
    for step in (0, 1):
        a, b = ([r for r in t if r[0] == step] for t in (truth, other))
        near = [(x, [y for y in b if km(*x[1:3], *y[1:3]) <= 20]) for x in a]
        agreeing = sum(any(all(alike(x[k], y[k]) for k in range(3, 3 + len(scalars))) for y in ys) for x, ys in near)
        assert found[step] == (len(a), len(b), sum(bool(ys) for _, ys in near), agreeing)


def test_compared_copies_each_fix_to_few_cubes(spark):
    rows = spark.range(500).select(F.lit(1).alias("step"), (F.col("id") % 100 - 50).cast("double").alias("lat"), (F.col("id") % 360).cast("double").alias("lon"))
    assert spheres.reached_cubes(rows, 4 * spheres.chord(20.0), 20.0).count() < 4 * 500  # 27 copies before
