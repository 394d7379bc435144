"""Discs, bumps and rules of tracks against plain loops and known values; errors that operators must raise."""

import itertools
import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldweave.functions import geo
from fieldweave.operators import cyclones, fields, graphs, gridding, meshes, spheres
from fieldweave.plans import campaign
from fieldweave.sources import tables
from fieldweave.streaming import writer

CELL = 5.0
PLACES = [(0.0, 0.0), (90.0, 0.0), (-90.0, 77.0), (88.0, 359.5), (-63.2, 180.0), (12.3, 357.9), (45.0, 2.4)]


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def grid():
    return [(r * CELL - 90, c * CELL) for r in range(int(180 / CELL) + 1) for c in range(int(360 / CELL))]


@pytest.mark.parametrize("radius", [300.0, 1500.0, 9000.0, 20100.0])
def test_cells_of_discs(spark, radius):
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(PLACES)], "id long, lat double, lon double")
    found = {(r["id"], r["cell_lat"], r["cell_lon"]) for r in spheres.disc_cells(points, F.lit(radius), CELL).collect()}
    want = {(i, *g) for i, p in enumerate(PLACES) for g in grid() if km(*p, *g) < radius}
    assert found == want
    table = spark.createDataFrame(grid(), "cell_lat double, cell_lon double")
    rows = spheres.near_cells(points, table, F.lit(radius), CELL).collect()
    assert len(rows) == len(want) and {(r["id"], r["cell_lat"], r["cell_lon"]) for r in rows} == want


def test_bumps_reach_as_far_as_the_error_asks(spark):
    rows = [(i % 3, *p, 1.0 + i) for i, p in enumerate(PLACES + PLACES[:2])]
    points = spark.createDataFrame(rows, "step long, lat double, lon double, v double")
    want = {(s, *g): sum(v * math.exp(-0.5 * (km(a, b, *g) / 700) ** 2) for t, a, b, v in rows if t == s) for s in range(3) for g in grid()}
    exact = {(r["step"], r["cell_lat"], r["cell_lon"]): r["gaussian"] for r in cyclones.gaussian_raster(points, 700.0, CELL, F.col("v"), ("step",)).collect()}
    assert exact.keys() == want.keys() and all(exact[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    near = {(r["step"], r["cell_lat"], r["cell_lon"]): r["gaussian"] for r in cyclones.gaussian_raster(points, 700.0, CELL, F.col("v"), ("step",), most_error=1e-3).collect()}
    assert len(near) < len(want) and all(abs(near.get(k, 0.0) - want[k]) <= 1e-3 * len(rows) for k in want)
    shares = cyclones.gaussian_raster(points, 700.0, CELL, None, ("step",), normalized=True).groupBy("step").agg(F.sum("gaussian").alias("n"))
    assert {r["step"]: round(r["n"], 6) for r in shares.collect()} == {s: float(sum(t == s for t, *_ in rows)) for s in range(3)}


def test_imputed_radii_keep_what_is_known(spark):
    rows = [(20.0, 10.0, 20.0, None, 5.0), (20.0, None, None, None, None), (40.0, None, None, None, None), (20.0, 1.0, 2.0, 3.0, 4.0), (None, None, None, None, None)]
    radii, flag = cyclones.impute([F.col(c) for c in "abcd"], F.col("w"), 34.0)
    found = spark.createDataFrame(rows, "w double, a double, b double, c double, d double").select(*radii, flag).collect()
    assert [tuple(r) for r in found] == [(10, 20, 35 / 3, 5, "mean"), (0, 0, 0, 0, "missing"), (0, 0, 0, 0, "zero"), (1, 2, 3, 4, "present"), (0, 0, 0, 0, "missing")]


def test_an_unknown_radius_of_maximum_wind_stays_unknown(spark):
    rows = [("a", 70.0, None, [30.0] * 4, [20.0] * 4, [20.0, 10.0, None, 5.0]), ("b", 70.0, 50.0, [30.0] * 4, [20.0] * 4, [20.0, 10.0, None, 5.0]), ("c", None, 50.0, [-1.0] * 4, [20.0] * 4, [25.0] * 4)]
    storms = spark.createDataFrame(rows, "sid string, wind_a double, rmw double, r34 array<double>, r50 array<double>, r64 array<double>")
    found = {r["sid"]: r for r in cyclones.consistent(storms).collect()}
    assert found["a"]["rmw"] is None and found["b"]["rmw"] == 20.0 and found["b"]["r50"] == [20.0] * 4
    assert found["c"]["rmw"] == 50.0 and found["c"]["r34"] == [25.0] * 4
    for mode in ("clip_rmw", "raise_radii"):
        assert all(r["radii_agree"] for r in cyclones.enforced(storms.where("wind_a is not null"), mode).collect())
    raised = {r["sid"]: r for r in cyclones.enforced(storms, "raise_radii").collect()}
    assert raised["b"]["rmw"] == 50.0 and raised["b"]["r64"] == [50.0, 10.0, None, 5.0] and raised["b"]["r34"][0] == 50.0
    with pytest.raises(ValueError):
        cyclones.enforced(storms, "other")


def test_rounding_to_bits(spark):
    values = [0.0, 1.0, -1.5, 3.14159, 1e-40, -1e-42, 5e-324, float("inf"), float("-inf"), float("nan"), 1e38, 0.1]
    found = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(geo.bit_round(F.col("x"), 7)).collect()]
    for v, got in zip(values, found, strict=True):
        if math.isnan(v) or math.isinf(v) or v == 0:
            assert got == v or (math.isnan(got) and math.isnan(v))
        else:
            unit = 2.0 ** (max(math.floor(math.log2(abs(v))), -126) - 7)
            assert got == round(v / unit) * unit


def test_calibration_without_overlap(spark):
    rows = spark.createDataFrame([(1, 10.0, None, 5.0), (2, 20.0, None, 10.0), (3, None, 7.0, 15.0)], "k int, a double, b double, c double")
    found = {r["k"]: r["merged"] for r in cyclones.calibrated_wind(rows, "a", ["b", "c"]).collect()}
    assert found == {1: 10.0, 2: 20.0, 3: pytest.approx((7 + 30) / 2)}
    on_base = {r["k"]: r["merged"] for r in cyclones.calibrated_wind(rows, "a", ["c"], on_base=True).collect()}
    assert on_base[1] == pytest.approx((10 + 2.5) / 2)
    with pytest.raises(PySparkException, match="no common storms"):
        cyclones.calibrated_wind(rows, "a", ["b"], skip_without_overlap=False).collect()
    few = {r["k"]: r["merged"] for r in cyclones.calibrated_wind(rows, "a", ["c"], when=F.col("k") < 0).collect()}
    assert few[3] == 15.0


def test_what_models_refuse(spark):
    rows = spark.createDataFrame([("t", 1, float("nan")), ("sst", 1, float("nan")), ("t", 0, 2.0)], "variable string, step long, value double")
    assert fields.initial_conditions(rows, F.lit(1), ["t", "sst"], may_lack=("t", "sst")).count() == 3
    with pytest.raises(PySparkException, match="NaN in t"):
        fields.initial_conditions(rows, F.lit(1), ["t", "sst"], may_lack=("sst",)).collect()
    with pytest.raises(ValueError, match="both"):
        fields.roles(rows, [], ["t"], ["t"], F.lit(1))
    losses = spark.createDataFrame([("t", 2.0), ("u", 3.0)], "variable string, loss double")
    assert fields.total_loss(losses, {"t": 0.5}).first()["total"] == 4.0
    with pytest.raises(ValueError, match="unknown"):
        fields.total_loss(losses, {"x": 1.0})
    names = spark.createDataFrame([("a", "x", True), ("b", "x", True)], "role string, variable string, has_grid boolean")
    assert {r["name"] for r in fields.routed(names, [], {"a": "a_"}).collect()} == {"a_x", "x"}
    with pytest.raises(PySparkException, match="two variables"):
        fields.routed(names, [], {}).collect()


def test_solver_of_second_order(spark):
    levels = [10.0, 3.0, 0.5, 0.0]
    denoise = lambda x, s: x / (1 + s * s)
    x = 7.0
    for now, after in itertools.pairwise(levels):
        clean = denoise(x, now)
        if after:
            middle = math.sqrt(now * after)
            x = after / now * x + (1 - after / now) * denoise(middle / now * x + (1 - middle / now) * clean, middle)
        else:
            x = clean
    assert fields.sampled(spark.createDataFrame([(7.0,)], "x double"), levels, denoise, "x").first()["sample"] == pytest.approx(x)


def test_graphs_of_a_model(spark):
    draw = np.random.default_rng(1).normal(size=(50, 3))
    draw /= np.linalg.norm(draw, axis=1)[:, None]
    points = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(draw)], "vec_id long, x double, y double, z double")
    vertices = meshes.hierarchy(2)[0]
    found = meshes.model_graphs(points, 2)
    reach = 0.6 * meshes.longest_edge(2)
    want = {(i, j) for i in range(50) for j in range(len(vertices)) if np.linalg.norm(draw[i] - vertices[j]) <= reach}
    assert {(r["sender"], r["receiver"]) for r in found["grid2mesh"].collect()} == want
    assert found["mesh2grid"].groupBy("receiver").count().where("count <> 3").count() == 0
    assert found["mesh"].count() == 2 * sum(30 * 4**k for k in range(3))
    assert meshes.model_graphs(points, 2, meshes="finest")["mesh"].count() == 2 * 30 * 16
    closest = {r["vec_id"]: r["vertex"] for r in meshes.connected(points, 2, "closest").collect()}
    assert all(closest[i] == int(np.argmin(np.linalg.norm(vertices - draw[i], axis=1))) for i in range(50))
    with pytest.raises(ValueError):
        meshes.connected(points, 2, "other")
    assert meshes.label(None, 4) == "4" and meshes.label("4", 5) == "4_5"


def test_spread_padding(spark):
    edges = spark.createDataFrame([(g, i, i, i + 1) for g, n in ((0, 1), (1, 5), (2, 8)) for i in range(n)], "g int, o int, sender long, receiver long")
    found = {}
    for r in graphs.padded_edges(edges, "g", ["o"], 8, spread=True).collect():
        found.setdefault(r["g"], {})[r["slot"]] = r["sender"]
    for g, n in ((0, 1), (1, 5), (2, 8)):
        want = dict.fromkeys(range(8), -1) | {(i * 7 // (n - 1) if n > 1 else 0): i for i in range(n)}
        assert found[g] == want


def test_store_takes_members_in_order(spark):
    rows = spark.createDataFrame([(m, "t", s, 1.0 * m) for m in range(4) for s in range(1, 10)], "member int, variable string, step long, value double")
    group = lambda a, b, n=9: rows.where(F.col("member").between(a, b) & (F.col("step") <= n))
    path = tables.shared_folder(spark, "store")
    store = writer.ForecastStore(spark, path, 4, steps=9)
    with pytest.raises(ValueError, match="0 is next"):
        store.write_batch(group(1, 2), 0)
    store.write_batch(group(0, 1), 0)
    store.write_batch(group(0, 1), 0)  # the same batch again replaces itself
    for bad, why in ((group(0, 1), "2 is next"), (group(3, 3), "2 is next"), (group(2, 3, 8), "do not have 9"), (group(2, 3).where("member = 2").unionByName(group(3, 3).withColumn("member", F.lit(4))), "gap")):
        with pytest.raises(ValueError, match=why):
            store.write_batch(bad, 1)
    with pytest.raises(ValueError, match="never written"):
        store.publish([])
    wide = group(2, 3).unionByName(group(3, 3).withColumn("member", F.lit(4)))
    with pytest.raises(ValueError, match="of a forecast of 4"):
        store.write_batch(wide, 1)
    store.write_batch(group(2, 3), 1)
    store.publish([])
    assert store.frames().count() == 36
    # Steps 1 to 9: two whole days; the ninth step's day is dropped.
    assert {(r["member"], r["day"], r["daily_sum"]) for r in store.daily().collect()} == {(m, d, 4.0 * m) for m in range(4) for d in (0, 1)}
    with pytest.raises(ValueError, match="there already"):
        writer.ForecastStore(spark, path, 4)
    assert tables.stored_bytes(spark, path).first()["files"] > 0


def test_store_from_a_stream(spark):
    source, path = tables.shared_folder(spark, "source"), tables.shared_folder(spark, "store")
    schema = "member int, variable string, step long, value double"
    for m in range(3):  # a file a member, read in order of time
        spark.createDataFrame([(m, v, s, 1.0) for v in ("t", "u") for s in range(1, 5)], schema).coalesce(1).write.mode("append").parquet(source)
    store = writer.ForecastStore(spark, path, 3, steps=4, variables=["t"])
    writer.stream_into(store, spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source), tables.shared_folder(spark, "state"))
    store.publish([])
    assert store.frames().count() == 12 and store.daily().count() == 3


def test_folds_of_edge_days(spark):
    rows = spark.createDataFrame([("a", s, 1.0) for s in (2, 3, 4, 5, 6, 7, 8, 9)] + [("b", s, float("nan") if s == 6 else 1.0) for s in (5, 6, 7, 8)], "k string, step long, value double")
    found = {(r["k"], r["day"]): (r["steps"], r["daily_sum"]) for r in fields.daily_fold(rows, ["k"]).collect()}
    assert found == {("a", 1): (4, 4.0), ("b", 1): (4, None)}
    assert fields.daily_fold(rows, ["k"], whole=False).count() == 4


def test_kept_months(spark):
    inits = campaign.calendar(spark, 2001, 2001)
    assert campaign.filter_months(inits, [1]).count() == inits.count() - 8 and campaign.filter_months(inits, []).count() == inits.count()


def test_gridded_families(spark):
    fixes = spark.createDataFrame([("a", 1, 10.0, 20.0, 50.0, 2.0, [100.0, None, 100.0, 100.0]), ("b", 1, -30.0, 200.0, float("nan"), -5.0, [None] * 4), ("c", 9, 0.0, 0.0, 10.0, 0.0, [None] * 4)], "track_id string, step long, lat double, lon double, wind double, category double, radii array<double>")
    found = gridding.gridded(fixes, 1, 2, CELL, 500.0, ["wind"], 600.0, "category", {"r34": ("radii", "wind", 34.0)}, 600.0, core=False).cache()
    assert {r["step"] for r in found.select("step").distinct().collect()} == {1}
    names = {r["variable"] for r in found.select("variable").distinct().collect()}
    assert {"cyclone_exists_sparse", "cyclone_wind_disc", "cyclone_category_disc", "cyclone_r34_shape", "cyclone_r34_se_radius_disc"} <= names
    value = lambda name, lat, lon: [r["value"] for r in found.where((F.col("variable") == name) & (F.col("cell_lat") == lat) & (F.col("cell_lon") == lon)).collect()]
    assert value("cyclone_wind_disc", 10.0, 20.0) == [50.0] and math.isnan(value("cyclone_wind_disc", -30.0, 200.0)[0])
    assert value("cyclone_category_disc", -30.0, 200.0) == [1.0] and value("cyclone_r34_se_radius_disc", 10.0, 20.0) == [100.0]
    assert math.isnan(value("cyclone_r34_shape", -30.0, 200.0)[0])


def test_whole_bumps_are_summed_in_arrays(spark):
    """No row for a place and cell, and frames without a key, null weights and NaN as sums of rows have them."""
    rows = [(None, "a", 10.0, 350.0, 2.0), (None, "a", 10.0, 350.0, None), (1, "a", -90.0, 0.0, None), (2, "b", 5.5, 7.25, float("nan")), (2, None, 89.0, 181.0, 1.0), (2, None, -30.0, 40.0, 3.0), (3, "c", None, 1.0, 1.0)]
    found = cyclones.gaussian_raster(spark.createDataFrame(rows, "step int, name string, lat double, lon double, v double"), 900.0, 10.0, F.col("v"), ("step", "name"))
    assert "explode" not in found._jdf.queryExecution().toString().lower()
    cells = {}
    for r in found.collect():
        cells.setdefault((r["step"], r["name"]), {})[r["cell_lat"], r["cell_lon"]] = r["gaussian"]
    assert set(cells) == {(None, "a"), (1, "a"), (2, "b"), (2, None)} and {len(c) for c in cells.values()} == {19 * 36}
    assert set(cells[1, "a"].values()) == {None} and all(math.isnan(v) for v in cells[2, "b"].values())
    for (y, x), v in cells[2, None].items():
        assert v == pytest.approx(sum(w * math.exp(-0.5 * (km(y, x, a, o) / 900) ** 2) for a, o, w in ((89.0, 181.0, 1.0), (-30.0, 40.0, 3.0))), abs=1e-12)
