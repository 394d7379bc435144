"""Samplers, masks of walks, attention in blocks, rollouts of models, and stores that are taken up again."""

import math
import sys
import time

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from fieldweave.functions import noise
from fieldweave.operators import fields, graphs, intervals, models, spheres
from fieldweave.plans.deep import LEVELS, RATES
from fieldweave.sources import tables
from fieldweave.streaming import daily, writer

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not see the tests


def shrunk(x, level):
    return x / (1 + level * level)


def plain_sample(x, levels, rates, draws, inflation):
    for i, (now, after) in enumerate(zip(levels, levels[1:])):
        raised = now * (1 + rates[i])
        x = x + (math.sqrt(raised**2 - now**2) * inflation * draws[i + 1] if rates[i] else 0)
        clean = shrunk(x, raised)
        middle = math.sqrt(raised * after)
        half = x * middle / raised + clean * (1 - middle / raised)
        x = clean if after == 0 else x * after / raised + shrunk(half, middle) * (1 - after / raised)
    return x


def test_sampler_with_churn(spark):
    rng = np.random.default_rng(1)
    draws = rng.normal(size=(40, len(LEVELS)))
    rows = spark.createDataFrame([(i, d.tolist()) for i, d in enumerate(draws)], "id long, d array<double>")
    found = {r["id"]: r["sample"] for r in fields.sampled(rows, LEVELS, shrunk, None, RATES, F.col("d"), 1.1).collect()}
    assert any(RATES) and len(LEVELS) == 21
    for i, d in enumerate(draws):
        assert found[i] == pytest.approx(plain_sample(LEVELS[0] * d[0], LEVELS, RATES, d, 1.1), rel=1e-9)
    with pytest.raises(ValueError, match="draws"):
        fields.sampled(rows, LEVELS, shrunk, None)


def test_samples_have_the_data_s_moments(spark):
    """The exact denoiser of standard normal data gives standard normal samples, with churn too."""
    rows = spark.range(8000)
    draws = F.array(*[noise.normal(noise.key_of(3, F.col("id"), F.lit(i))) for i in range(len(LEVELS))])
    mean, std = fields.sampled(rows, LEVELS, shrunk, None, RATES, draws).agg(F.avg("sample"), F.stddev("sample")).first()
    assert abs(mean) < 0.05 and abs(std - 1) < 0.05


def test_many_levels_take_no_longer_to_plan(spark):
    began = time.time()
    rows = spark.range(10).withColumn("x", F.lit(2.0))
    levels = fields.noise_levels(80.0, 0.03, 200, 7.0)
    assert fields.sampled(rows, levels, shrunk, "x").agg(F.sum("sample")).first()[0] is not None
    assert time.time() - began < 30


def test_walks(spark):
    rng = np.random.default_rng(2)
    pairs = {(int(a), int(b)) for a, b in rng.integers(0, 30, (60, 2))}
    found = {(r["sender"], r["receiver"]): r["hops"] for r in graphs.k_hop(spark.createDataFrame(sorted(pairs) * 2, "sender long, receiver long"), 4).collect()}
    want = {(v, v): 0 for p in pairs for v in p}
    reach = dict(want)
    for n in range(1, 5):
        reach = {(a, c): n for a, b in reach for b2, c in pairs if b == b2}
        want |= {k: n for k in reach if k not in want}
    assert found == want
    alone = graphs.k_hop(spark.createDataFrame([(1, 2), (2, 1)], "sender long, receiver long"), 5, self_edges=False)
    assert {tuple(r) for r in alone.collect()} == {(1, 2, 1), (2, 1, 1), (1, 1, 2), (2, 2, 2)}
    assert graphs.k_hop(spark.createDataFrame([], "sender long, receiver long"), 2).count() == 0


@pytest.mark.parametrize("block", [4, 7, 64])
def test_attention_in_blocks(spark, block):
    """As edge by edge, also for large logits, receivers whose edges lie in one block, and absent nodes."""
    rng = np.random.default_rng(block)
    n = 45
    q, k, v = rng.normal(size=(n, 3)) * 30, rng.normal(size=(n, 3)) * 10, rng.normal(size=(n, 2))
    nodes = spark.createDataFrame([(i, *[a[i].tolist() for a in (q, k, v)]) for i in range(n) if i != 20], "node long, q array<double>, k array<double>, v array<double>")
    edges = [(s, r) for r in range(n) for s in range(max(0, r - 4), min(n, r + 5)) if rng.random() < 0.6 and r != 13]
    table = spark.createDataFrame(edges * 2, "sender long, receiver long")
    found = {r["receiver"]: (r["edges"], r["attended"]) for r in graphs.block_attention(nodes, table, block).collect()}
    for r in range(n):
        own = [s for s, at in edges if at == r and 20 not in (s, r)]
        assert (r in found) == bool(own)
        if own:
            logit = np.array([q[r] @ k[s] / math.sqrt(3) for s in own])
            w = np.exp(logit - logit.max())
            assert found[r][0] == len(own) and np.allclose(found[r][1], w @ v[own] / w.sum())
    with pytest.raises(Exception, match="longer than a block"):
        graphs.block_attention(nodes, spark.createDataFrame([(0, 44)], "sender long, receiver long"), 4).collect()


def linear(inputs, forcings, step):
    return 0.5 * inputs[:, 1] + 0.2 * inputs[:, 0] + (forcings * step if forcings.shape[1] else 0)


def neighbours(inputs, forcings, step):
    """A model that looks around: each cell takes the mean of its frame's neighbours, in order of the keys."""
    return (np.roll(inputs[:, -1], 1, axis=0) + np.roll(inputs[:, -1], -1, axis=0)) / 2


@pytest.fixture(scope="module")
def frames(spark):
    rows = [(m, c, var, s, float(m + c * s + (7 if var == "b" else 0))) for m in range(3) for c in range(5) for var in "ab" for s in (3, 4, 5) if (m, c) != (2, 4) or s == 5]
    return spark.createDataFrame(rows, "member long, cell long, variable string, step long, value double")


@pytest.mark.parametrize("chunk", [1, 2, 5, 9])
def test_rollout_of_a_model(spark, frames, chunk):
    inputs = models.stacked(frames, ["member", "cell"], "step", ["a", "b"], 2)
    assert inputs.count() == 14  # a key with one frame has no rollout
    found = models.Rollout(tables.shared_folder(spark), linear, ["member", "cell"], chunk).run(inputs, 5)
    got = {(r["member"], r["cell"], r["variable"], r["lead"]): r["value"] for r in models.unstacked(found, ["a", "b"]).collect()}
    same = fields.rollout(frames, ["member", "cell", "variable"], "step", 5, lambda x, y: 0.5 * x + 0.2 * y)
    want = {(r["member"], r["cell"], r["variable"], r["lead"]): r["value"] for r in same.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_a_rollout_goes_on(spark, frames):
    calls, folder = spark.sparkContext.accumulator(0), tables.shared_folder(spark)
    inputs = models.stacked(frames, ["member", "cell"], "step", ["a", "b"], 2)
    forcings = inputs.select("member", "cell", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("lead")).withColumn("forcings", F.array(F.lit(1.0)))

    def breaking(inputs, forcings, step):
        if step == 5:
            raise RuntimeError("lost")
        return linear(inputs, forcings, step)

    def counting(inputs, forcings, step):
        calls.add(1 if step < 5 else 0)
        return linear(inputs, forcings, step)

    with pytest.raises(Exception, match="lost"):
        models.Rollout(folder, breaking, ["member", "cell"], 2).run(inputs, 6, forcings).count()
    rows = lambda df: sorted((r["member"], r["cell"], r["lead"], *r["channels"]) for r in df.collect())
    after = rows(models.Rollout(folder, counting, ["member", "cell"], 2).run(inputs, 6, forcings))
    assert calls.value == 0  # leads 1 to 4 were not computed again
    assert after == rows(models.Rollout(tables.shared_folder(spark), linear, ["member", "cell"], 6).run(inputs, 6, forcings))
    with pytest.raises(Exception, match="lacks its forcings"):
        models.Rollout(tables.shared_folder(spark), linear, ["member", "cell"], 3).run(inputs, 6, forcings.where("lead <> 2")).count()


def test_models_that_look_around(spark, frames):
    inputs = models.stacked(frames.where("member < 2"), ["member", "cell"], "step", ["a", "b"], 1)
    found = models.Rollout(tables.shared_folder(spark), neighbours, ["member", "cell"], 2, by=["member"]).run(inputs, 3)
    state = {m: np.array([[m + 5.0 * c, m + 5.0 * c + 7] for c in range(5)]) for m in range(2)}
    for lead in range(1, 4):
        state = {m: (np.roll(x, 1, axis=0) + np.roll(x, -1, axis=0)) / 2 for m, x in state.items()}
        for r in found.where(F.col("lead") == lead).collect():
            assert np.allclose(r["channels"], state[r["member"]][r["cell"]])
    bad = models.Rollout(tables.shared_folder(spark), lambda inputs, forcings, step: inputs[:, 0, :1], ["member", "cell"], 2)
    with pytest.raises(Exception, match="was expected"):
        bad.run(inputs, 1)


def test_a_store_goes_on_after_its_driver(spark):
    rows = spark.createDataFrame([(m, "t", s, 1.0 * m) for m in range(4) for s in range(1, 9)], "member int, variable string, step long, value double")
    group = lambda a, b: rows.where(F.col("member").between(a, b))
    path = tables.shared_folder(spark, "store")
    writer.ForecastStore(spark, path, 4).write_batch(group(0, 1), 0)
    group(2, 2).write.parquet(f"{path}_partial/frames/batch=1")  # a batch that was written and never noted
    again = writer.ForecastStore(spark, path, 4, resume=True)
    assert again.next_batch() == (1, 2)
    again.write_batch(group(2, 3), 5)
    again.publish([])
    assert sorted(r["member"] for r in again.frames().select("member").distinct().collect()) == [0, 1, 2, 3] and again.frames().count() == 32
    other = tables.shared_folder(spark, "store")
    writer.ForecastStore(spark, other, 4).write_batch(group(0, 1), 0)
    clean = writer.ForecastStore(spark, other, 4)
    assert clean.next_batch() == (0, 0)
    clean.write_batch(group(0, 3), 0)
    clean.publish([])
    assert clean.frames().count() == 32


def test_radii_have_no_cap(spark):
    """Discs and quadrants of any radius, side by side, against every cell of the grid."""
    cell, rows = 10.0, [(0, 10.0, 20.0, 400.0), (1, -60.0, 350.0, 2000.0), (2, 85.0, 100.0, 6000.0), (3, 0.0, 0.0, None), (4, 5.0, 5.0, 21000.0)]
    points = spark.createDataFrame(rows, "id long, lat double, lon double, radius double")
    km = lambda a, b, c, d: 2 * 6371.0 * math.asin(min(1.0, math.sqrt(math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2)))
    grid = [(r * cell - 90, c * cell) for r in range(19) for c in range(36)]
    found = {(r["id"], r["cell_lat"], r["cell_lon"]) for r in spheres.disc_cells(points, F.col("radius"), cell).collect()}
    assert found == {(i, *g) for i, a, b, radius in rows for g in grid if radius and km(a, b, *g) < radius}
    shapes = points.where("radius < 9000").withColumn("radii", F.array("radius", F.col("radius") / 2, F.lit(None).cast("double"), F.lit(0.0)))
    got = {(r["cell_lat"], r["cell_lon"]): r["covered"] for r in spheres.quadrant_raster(shapes, "radii", F.lit(1), cell, 2).collect()}
    want = {}
    for i, a, b, radius in rows:
        for lat, lon in grid if radius and radius < 9000 else []:
            inside = 0
            for di in (-0.25, 0.25):
                for dj in (-0.25, 0.25):
                    la, lo = max(-90.0, min(90.0, lat + di * cell)), (lon + dj * cell) % 360
                    north, east = la >= a, (lo - b) % 360 < 180
                    radii = {(True, True): radius, (False, True): radius / 2}.get((north, east), 0.0)
                    inside += km(a, b, la, lo) < radii
            if inside:
                want[lat, lon] = want.get((lat, lon), 0) + inside / 4
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_noise_on_a_grid_is_that_at_its_points(spark):
    power = [0.0, 1.0, 0.5, 0.25, 0.1, 0.1, 0.05]
    keys = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "key string, member int")
    lats, lons = [-90.0, -37.5, 0.0, 60.0, 90.0], [0.0, 45.0, 123.0, 359.0]
    rows = noise.isotropic_grid(keys, "key", lats, lons, power)
    both = rows.withColumn("other", noise.isotropic(F.col("lat"), F.col("lon"), F.col("key"), power)).collect()
    assert len(both) == 2 * len(lats) * len(lons) and {r["member"] for r in both} == {1, 2}
    assert np.allclose([r["noise"] for r in both], [r["other"] for r in both], atol=1e-9)


def test_spans_and_moments(spark):
    rng = np.random.default_rng(3)
    spans = [(i, int(a), int(a + n)) for i, (a, n) in enumerate(zip(rng.integers(-50, 50, 60), rng.integers(-2, 40, 60)))] + [(99, None, 5)]
    moments = [int(t) for t in rng.integers(-60, 90, 40)] + [None]
    left = spark.createDataFrame(spans, "id long, a long, b long")
    right = spark.createDataFrame([(i, t) for i, t in enumerate(moments)], "m long, t long")
    want = sorted((i, m) for i, a, b in spans for m, t in enumerate(moments) if a is not None and t is not None and a <= t <= b)
    for bucket in (1, 7, 500):
        assert sorted((r["id"], r["m"]) for r in intervals.spans_at(left, right, "a", "b", "t", bucket).collect()) == want


def test_storms_around_the_turn_of_a_year(spark):
    year = 365 * 4  # steps from 1970 on
    fixes = [("long", s) for s in range(0, 3 * year, 1)] + [("gap", s) for s in range(year - 9, year + 9) if s != year] + [("old", s) for s in range(year - 20, year - 1)]
    table = spark.createDataFrame([(t, s, 1.0) for t, s in fixes], "track_id string, step long, lat double")
    inits = spark.createDataFrame([(year,), (year + 1,), (3 * year + 50,), (year,)], "init long")
    found = {(r["track_id"], r["init"], r["step"]) for r in intervals.storms_around(table, inits, 5).collect()}
    assert found == {(t, i, s) for i in (year, year + 1) for t, s in fixes if i - 5 <= s <= i and (t, i) in set(fixes)}
    assert {t for t, i, _ in found if i == year} == {"long"} and ("gap", year + 1, year - 1) in found
    old = intervals.storms_around(table, spark.createDataFrame([(2 * year + 1460,)], "init long"), 10 * year, years=1)
    assert old.count() == 0  # no fix at that step
    wide = intervals.storms_around(table.where("track_id = 'long'"), spark.createDataFrame([(3 * year - 1,)], "init long"), 10 * year, years=1).agg(F.min("step")).first()[0]
    assert wide == year  # 1972 less a year


def test_whole_days_of_a_stream(spark):
    """Steps that come in any order over many files, late ones, a repeated batch and a stream that stops in between."""
    rng = np.random.default_rng(8)
    rows = [(m, v, s, float(rng.normal()) if rng.random() > 0.01 else float("nan")) for m in range(3) for v in "ab" for s in range(1, 30) if rng.random() > 0.1 for _ in range(2)]
    rng.shuffle(rows)
    rows = [(int(m), str(v), int(s), float(x)) for m, v, s, x in rows]
    schema = "member long, variable string, step long, value double"
    source, folder = tables.shared_folder(spark, "source"), tables.shared_folder(spark, "days")
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    batches = []

    class Twice(daily.DailyStore):
        def write_batch(self, batch, number):
            super().write_batch(batch, number)
            super().write_batch(batch, number)  # as after a driver that was lost before the batch was noted
            batches.append(number)

    for part in range(4):
        spark.createDataFrame(rows[part::4], schema).coalesce(1).write.mode("append").parquet(source)
        if part in (1, 3):
            Twice(spark, folder, ["member", "variable"]).run(stream())
    assert len(set(batches)) >= 4
    plain = lambda df: sorted((r["member"], r["variable"], r["day"], r["steps"], *[None if r[f"daily_{c}"] is None else round(r[f"daily_{c}"], 9) for c in ("mean", "sum", "least", "greatest")]) for r in df.collect())
    want = plain(fields.daily_fold(spark.createDataFrame(rows, schema), ["member", "variable"]))
    assert want and plain(daily.DailyStore(spark, folder, ["member", "variable"]).days()) == want
