"""Tracks from a stream against those of the batch."""

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fieldweave.operators import tracker
from fieldweave.sources.tables import shared_folder
from fieldweave.streaming import tracks

SETTINGS = tracker.Settings(cell=10.0, mode_km=2000, mean_km=2000, existence_km=3000, refinement_km=2000, scalar_km=1500, apart_km=2500, prune_km=2500, box=30, box_threshold=0.4, least_steps=1)


@pytest.fixture(scope="module")
def grid(spark):
    draw = np.random.default_rng(5)
    steps = [(run, step) for run in range(3) for step in range(7) if (run, step) != (1, 3)]  # a gap, which ends tracks
    rows = [(run, step, float(lat), float(lon), float(max(0, draw.normal(-0.5, 0.5))) + 0.8 * bool(abs(lat - 5 * step + 20) < 11 and lon in (90.0, 100.0)), float(lat)) for run, step in steps for lat in np.arange(-90.0, 91, 10) for lon in np.arange(0.0, 360, 10)]
    return spark.createDataFrame(rows, "run long, step int, cell_lat double, cell_lon double, p double, height double").cache()


@pytest.fixture(scope="module")
def first(spark):
    return spark.createDataFrame([(0, "known", 0, -20.0, 90.0, None), (2, "other", 2, 60.0, -60.0, 7.0)], "run long, track string, step int, lat double, lon double, height double")


def rows(df):
    return {(r["run"], r["track"], r["step"]): [r["lat"], r["lon"], r["existence"], r["height"], r["merged_into"]] for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys() and len(want) > 20
    for k, v in want.items():
        assert v[4] == got[k][4] and np.allclose(np.array(v[:4], float), np.array(got[k][:4], float), atol=1e-9, equal_nan=True)


def stream(spark, folder, schema, files=2):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def test_equals_the_batch(spark, grid, first):
    want = rows(tracker.track(grid, first, SETTINGS, ["height"]))
    assert any(v[4] for v in want.values()) and any(k[1] == "known" for k in want)
    folder = shared_folder(spark, "frames")
    framed = tracks.framed(grid, first, ["height"])
    cut = framed.withColumn("part", F.pmod(F.xxhash64("run", "step", "cell_lat"), F.lit(4)))
    framed.join(cut.select("run", "step", "cell_lat", "part").distinct(), ["run", "step", "cell_lat"]).where("part < 3").drop("part").repartition(4, "cell_lat").write.parquet(f"{folder}/a")
    store = tracks.TrackStore(spark, shared_folder(spark, "tracks"), SETTINGS, ["height"])
    source = f"{folder}/*"
    store.run(stream(spark, source, framed.schema))
    # A new object takes up the state: the cells that were missing come, among them some of every early frame.
    cut.where("part = 3").drop("part").select(*framed.columns).repartition(2, "cell_lon").write.parquet(f"{folder}/b")
    later = tracks.TrackStore(spark, store.folder, SETTINGS, ["height"])
    later.run(stream(spark, source, framed.schema, 1))
    same(rows(later.tracks()), want)
    assert later.tracks(settled=False).count() > len(want)


def test_too_many_rows_and_late_rows_are_errors(spark, grid):
    framed, folder = tracks.framed(grid.where("run = 0 and step < 2").drop("height")), shared_folder(spark, "late")
    framed.coalesce(1).write.parquet(f"{folder}/a")
    store = tracks.TrackStore(spark, shared_folder(spark, "tracks"), SETTINGS)
    store.run(stream(spark, f"{folder}/*", framed.schema))
    framed.where("step = 1").limit(1).write.parquet(f"{folder}/b")
    with pytest.raises(StreamingQueryException, match="passed 1"):
        store.run(stream(spark, f"{folder}/*", framed.schema))
    twice = shared_folder(spark, "twice")
    framed.unionByName(framed).write.parquet(twice)
    with pytest.raises(StreamingQueryException, match="more than its"):
        tracks.TrackStore(spark, shared_folder(spark, "tracks"), SETTINGS).run(stream(spark, twice, framed.schema, 9))


def test_query_equals_the_batch(spark):
    from fieldweave.plans.catalogue import QUERIES

    names = ["run", "track", "step", "lat", "lon", "existence", "merged_into"]
    found, want = ([tuple(r) for r in QUERIES[q](spark, "/root/testdata/sf0.001").select(*names).orderBy("run", "track", "step").collect()] for q in ("streamed_tracks", "tracked_cyclones"))
    assert len(want) > 0 and [(*r[:3], r[6]) for r in found] == [(*r[:3], r[6]) for r in want]
    assert np.allclose(np.array([r[3:6] for r in found], float), np.array([r[3:6] for r in want], float), atol=2e-4)
