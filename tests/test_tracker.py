"""The tracker on fields whose storms are known."""

import math

import numpy as np
import pytest

from fieldweave.operators import tracker
from fieldweave.plans import geometry
from fieldweave.plans.geometry import TRACKING

CELL = 2.0
SETTINGS = tracker.Settings(cell=CELL, box=10.0, least_steps=2, mode_km=500.0, mean_km=500.0, existence_km=900.0, refinement_km=500.0, apart_km=900.0)


def blob(lat, lon, at_lat, at_lon):
    d = math.hypot(lat - at_lat, ((lon - at_lon + 180) % 360 - 180) * math.cos(math.radians(at_lat)))
    return math.exp(-((d / 2.5) ** 2))


def frames(paths, steps):
    for run, storms in enumerate(paths):
        for step in range(steps):
            for i in range(int(180 / CELL) + 1):
                for j in range(int(360 / CELL)):
                    lat, lon = i * CELL - 90, j * CELL
                    p = max((blob(lat, lon, *f(step)) for f in storms if f(step)), default=0.0)
                    if p > 1e-3 or (i + j) % 40 == 0:
                        yield run, step, lat, lon, p if p > 1e-3 else 0.0


@pytest.fixture(scope="module")
def found(spark):
    paths = [
        [lambda t: (10.0 + t, (356.0 + 2 * t) % 360), lambda t: (-20.0, 100.0) if t >= 2 else None],
        [lambda t: (0.0, 20.0 + 3 * t), lambda t: (0.0, 44.0 - t)],
    ]
    grid = spark.createDataFrame(list(frames(paths, 8)), "run long, step int, cell_lat double, cell_lon double, p double")
    start = spark.createDataFrame([(0, "known", 10.0, 356.0)], "run long, track string, lat double, lon double")
    rows = tracker.track(grid, start, SETTINGS).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r["run"], r["track"], r["step"])):
        out.setdefault((r["run"], r["track"]), []).append(r)
    return out


def test_follows_across_the_meridian(found):
    rows = found[0, "known"]
    assert [r["step"] for r in rows] == list(range(8))
    for r in rows:
        assert abs(r["lat"] - 10 - r["step"]) < 0.6 and abs((r["lon"] - 356 - 2 * r["step"] + 180) % 360 - 180) < 0.6


def test_finds_new_storms(found):
    rows = found[0, "cyclogenesis_0"]
    assert [r["step"] for r in rows] == list(range(2, 8))
    assert all(abs(r["lat"] + 20) < 0.6 and abs(r["lon"] - 100) < 0.6 for r in rows)


def test_prunes_the_faster_one(found):
    ends = [rows[-1] for (run, _), rows in found.items() if run == 1 and rows[-1]["merged_into"]]
    assert len(ends) == 1 and (1, ends[0]["merged_into"]) in found
    assert abs(ends[0]["lon"] - 20 - 3 * ends[0]["step"]) < 1.5  # the eastward storm moves three times as fast


def test_empty_grid(spark):
    grid = spark.createDataFrame([], "run long, step int, cell_lat double, cell_lon double, p double")
    assert tracker.track(grid, None, TRACKING).count() == 0


def test_guess_is_a_great_circle():
    assert np.allclose(tracker.guess(0.0, 10.0, (0.0, 6.0), 0.5), [0, 12])
    assert tracker.guess(3.0, 4.0, None, 0.9) == tracker.guess(3.0, 4.0, (3.0, 4.0), 0.9) == (3.0, 4.0)  # exactly where it was


def plain_tracks(rows, first, s, scalar):
    """The tracker over whole grids held as lists, cell by cell."""
    steps = sorted({r[1] for r in rows})
    place = lambda x: (math.degrees(math.atan2(x[2], math.hypot(x[0], x[1]))), math.degrees(math.atan2(x[1], x[0])) % 360)
    point = lambda lat, lon: [math.cos(math.radians(lat)) * math.cos(math.radians(lon)), math.cos(math.radians(lat)) * math.sin(math.radians(lon)), math.sin(math.radians(lat))]

    def km(a, b):
        h = math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * 6371.0 * math.asin(min(1, math.sqrt(h)))

    def mean(frame, at, radius):
        near = [(point(a, b), p) for a, b, p, _ in frame if km(at, (a, b)) < radius]
        return place([sum(x[i] * p for x, p in near) for i in range(3)]) if sum(p for _, p in near) > 0 else None

    def mode(frame, at, radius):
        near = [(-p, a, b) for a, b, p, _ in frame if km(at, (a, b)) < radius and p > 0]
        return min(near)[1:] if near else None

    def exists(frame, at):
        return sum(p for a, b, p, _ in frame if km(at, (a, b)) < s.existence_km) / len(frame) if at else 0

    def scalars(frame, at):
        near = [(p, v) for a, b, p, v in frame if km(at, (a, b)) < s.scalar_km]
        return sum(p * v for p, v in near) / sum(p for p, _ in near)

    out = {}
    for run in {r[0] for r in rows}:
        active, born = {}, 0
        for step in steps:
            frame, new = [r[2:] for r in rows if r[:2] == (run, step)], {}
            for name in sorted(active):
                now, was = active[name]
                at = now
                if was and km(now, was) > 1e-6:
                    x, y = point(*now), point(*was)
                    t = math.acos(sum(a * b for a, b in zip(x, y)))
                    at = place([math.cos(t * s.momentum) * a + math.sin(t * s.momentum) * (a * math.cos(t) - b) / math.sin(t) for a, b in zip(x, y)])
                at = mode(frame, at, s.mode_km)
                at = at and mean(frame, at, s.mean_km)
                if exists(frame, at) >= s.least_existence and at:
                    new[name] = (at, now)
            while pair := next(((a, b) for a in sorted(new) for b in sorted(new) if a != b and km(new[a][0], new[b][0]) < s.prune_km), None):
                far = [km(*new[n]) for n in pair]
                gone, stays = pair if far[0] >= far[1] else pair[::-1]
                out[run, gone][-1][4] = stays
                del new[gone]
            new |= {n: (at, None) for r, n, *at in ((r, n, a, b) for r, n, a, b in first) if r == run and step == steps[0]}
            new = {n: (tuple(at), was) for n, (at, was) in new.items()}
            boxes = {}
            for a, b, p, _ in frame:
                if p > s.box_threshold:
                    box = (a + 90) // s.box, b // s.box
                    boxes[box] = min(boxes.get(box, (0, 0, 0)), (-p, a, b))
            for _, a, b in sorted(boxes.values()):
                at = abs(a) <= s.most_lat and all(km((a, b), c[0]) >= s.apart_km for c in new.values()) and mean(frame, (a, b), s.refinement_km)
                if at and exists(frame, at) >= s.least_existence and all(km(at, c[0]) >= s.apart_km for c in new.values()):
                    new[f"cyclogenesis_{born}"] = (at, None)
                    born += 1
            for name, (at, _) in new.items():
                known = (run, name) not in out and not name.startswith("cyclo")
                out.setdefault((run, name), []).append([step, *at, math.nan if known else scalars(frame, at), None])
            active = new
    return {k: v for k, v in out.items() if not k[1].startswith("cyclo") or len(v) > s.least_steps}


def test_equals_plain_loops(spark):
    draw = np.random.default_rng(5)
    rows = [(run, step, float(lat), float(lon), float(max(0, draw.normal(-0.5, 0.5))) + 0.8 * bool(abs(lat - 5 * step + 20) < 11 and lon in (90.0, 100.0)), float(lat)) for run in range(3) for step in range(6) for lat in np.arange(-90.0, 91, 10) for lon in np.arange(0.0, 360, 10)]
    s = tracker.Settings(cell=10.0, mode_km=2000, mean_km=2000, existence_km=3000, refinement_km=2000, scalar_km=1500, apart_km=2500, prune_km=2500, box=30, box_threshold=0.4, least_steps=1)
    first = [(0, "known", -20.0, 90.0), (2, "other", 60.0, 300.0)]
    want = plain_tracks(rows, first, s, 5)
    grid = spark.createDataFrame(rows, "run long, step int, cell_lat double, cell_lon double, p double, height double")
    start = spark.createDataFrame(first, "run long, track string, lat double, lon double")
    got = {}
    for r in sorted(tracker.track(grid, start, s, ["height"]).collect(), key=lambda r: r["step"]):
        got.setdefault((r["run"], r["track"]), []).append([r["step"], r["lat"], r["lon"], r["height"], r["merged_into"]])
    assert got.keys() == want.keys() and len(want) > 10
    for k, rows in want.items():
        assert [(r[0], r[4]) for r in rows] == [(r[0], r[4]) for r in got[k]]
        assert np.allclose(np.array([r[1:4] for r in rows], float), np.array([r[1:4] for r in got[k]], float), atol=1e-6, equal_nan=True)
    assert any(r[4] for rows in want.values() for r in rows)


def test_a_gap_ends_tracks(spark):
    rows = [(0, step, 10.0, lon, p) for step in (0, 1, 2, 5, 6, 7) for lon, p in ((100.0, 0.9), (300.0, 0.0))]
    grid = spark.createDataFrame(rows, "run long, step int, cell_lat double, cell_lon double, p double")
    s = tracker.Settings(cell=10.0, least_steps=2)
    found = sorted((r["track"], r["step"]) for r in tracker.track(grid, None, s).collect())
    assert found == [(f"cyclogenesis_{k}", step) for k, steps in enumerate(((0, 1, 2), (5, 6, 7))) for step in steps]
    wide = spark.createDataFrame([(0, 6 * r[1], *r[2:]) for r in rows if r[1] < 3], grid.schema)
    assert tracker.track(wide, None, s, every=6).count() == 3


def test_scalars_obey_physics(spark):
    radii = {f"{name}_{i}": float(10 * i + k) for k, name in enumerate(("r34", "r50", "r64")) for i in (1, 2, 3, 4)}
    row = {"run": 0, "track": "a", "step": 1, "wind": 55.0, "rmw": 300.0, "pressure": 990.0} | radii
    out = tracker.consistent(spark.createDataFrame([row, row | {"wind": math.nan, "rmw": -1.0}])).collect()
    assert out[0]["r64"] == [0, 0, 0, 0] and out[0]["r34"] == [11, 21, 31, 41] and out[0]["rmw"] == 41 and out[0]["radii_agree"]
    assert out[1]["wind"] is None and out[1]["rmw"] == 0 and out[1]["pressure"] == 990


def test_query_tracks_every_step(spark, monkeypatch):
    rows = [(0, step, lat, lon, v) for step in range(500, 512) for lat, lon, v in ((10.0, 100.0, 500.0), (-40.0, 200.0, 0.0))]
    table = spark.createDataFrame(rows, "member long, step long, lat double, lon double, value double")
    monkeypatch.setattr(geometry, "field", lambda *_: table)
    found = geometry.tracked_cyclones(spark, "").collect()
    assert sorted((r["track"], r["step"]) for r in found) == [("cyclogenesis_0", step) for step in range(500, 512)]
