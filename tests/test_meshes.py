"""Meshes and geodesics against brute force and known values."""

import math

import numpy as np
import pytest

from fieldweave.functions.geo import WGS84, _inverse_km
from fieldweave.operators import meshes
from fieldweave.plans.catalogue import QUERIES
from fieldweave.sources.views import points

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("splits", [0, 1, 2, 3])
def test_hierarchy(splits):
    vertices, levels = meshes.hierarchy(splits)
    assert len(vertices) == 10 * 4**splits + 2 and [len(f) for f in levels] == [20 * 4**n for n in range(splits + 1)]
    assert np.allclose(np.linalg.norm(vertices, axis=1), 1) and np.allclose(vertices[:12], meshes.icosahedron()[0])
    corners = vertices[levels[-1]]
    assert (np.linalg.det(corners) > 0).all()
    sides = np.linalg.norm(corners - np.roll(corners, 1, axis=1), axis=2) ** 2
    assert (sides.sum(axis=1) > 2 * sides.max(axis=1)).all()  # acute, as closest_vertices() needs
    edges = {tuple(sorted(e)) for a, b, c in levels[-1].tolist() for e in ((a, b), (b, c), (c, a))}
    assert len(vertices) - len(edges) + len(levels[-1]) == 2


def test_poles_lie_in_faces():
    vertices, faces = meshes.icosahedron()
    top = faces[np.argmax(vertices[faces].sum(axis=1)[:, 2])]
    assert np.ptp(vertices[top][:, 2]) < 1e-12


def test_points_meet_their_faces(spark):
    vertices, levels = meshes.hierarchy(3)
    at = {r["vec_id"]: np.array([r["x"], r["y"], r["z"]]) for r in points(spark, SF).collect()}
    found = QUERIES["mesh_faces"](spark, SF).collect()
    assert sorted(r["vec_id"] for r in found) == sorted(at)
    corners = vertices[levels[3]]
    sides = np.cross(corners, np.roll(corners, -1, axis=1))
    for r in found:
        assert levels[3][r["face"]].tolist() == [r["a"], r["b"], r["c"]]
        depth = (sides @ at[r["vec_id"]]).min(axis=1)
        assert depth[r["face"]] >= depth.max() - 1e-9


def test_closest_vertices(spark):
    vertices, _ = meshes.hierarchy(3)
    at = {r["vec_id"]: np.array([r["x"], r["y"], r["z"]]) for r in points(spark, SF).collect()}
    for r in QUERIES["mesh_closest"](spark, SF).collect():
        d = np.linalg.norm(vertices - at[r["vec_id"]], axis=1)
        assert abs(d.min() - r["distance"]) < 1e-8 and abs(d[r["vertex"]] - d.min()) < 1e-8


def test_geodesics():
    one = lambda *x: float(_inverse_km(*[np.array([float(v)]) for v in x], *WGS84)[0])
    assert one(10, 20, 10, 20) == 0
    assert abs(one(0, 0, 0, 1) - 6378.137 * math.pi / 180) < 1e-6
    assert abs(one(0, 0, 90, 0) - 10001.965729) < 1e-5
    assert abs(one(50.06632, -5.71475, 58.64402, -3.07009) - one(58.64402, -3.07009, 50.06632, -5.71475)) < 1e-9


def test_ellipsoid_is_near_the_sphere(spark):
    assert all(0 <= r["km"] < 20004 for r in QUERIES["ellipsoid_distances"](spark, SF).collect())


def test_graphs_with_features(spark):
    draw = np.random.default_rng(2).normal(size=(40, 3))
    draw /= np.linalg.norm(draw, axis=1)[:, None]
    points = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(draw)], "vec_id long, x double, y double, z double")
    place = {"grid": draw, "mesh": meshes.hierarchy(1)[0]}
    nodes, edges = meshes.featured_graphs(points, 1, multiple=16)
    rows = nodes.collect()
    assert len(rows) == 40 + len(place["mesh"])
    for r in rows:
        x, y, z = place[r["set"]][r["node"]]
        assert np.allclose(r["features"], [z, *(np.array([x, y]) / max(np.hypot(x, y), 1e-300))], atol=1e-6) or np.hypot(x, y) < 1e-9
    found = {}
    for r in edges.collect():
        found.setdefault(r["graph"], []).append(r)
    graphs = meshes.model_graphs(points, 1)
    for graph, rows in found.items():
        rows.sort(key=lambda r: r["slot"])
        want = sorted((r["receiver"], r["sender"]) for r in graphs[graph].collect())
        assert [r["slot"] for r in rows] == list(range(-(-len(want) // 16) * 16))
        assert [(r["receiver"], r["sender"]) for r in rows] == want + [(-1, -1)] * (len(rows) - len(want))
        first, last = meshes.ENDS[graph]
        ends = [(place[first][s], place[last][r]) for r, s in want]
        longest = max(np.linalg.norm(a - b) for a, b in ends)
        for r, (a, b) in zip(rows, ends, strict=False):
            turn, up = np.arctan2(b[1], b[0]), np.arcsin(b[2])
            flat = np.array([[np.cos(turn), np.sin(turn), 0], [-np.sin(turn), np.cos(turn), 0], [0, 0, 1]])
            level = np.array([[np.cos(up), 0, np.sin(up)], [0, 1, 0], [-np.sin(up), 0, np.cos(up)]])
            assert np.allclose(r["features"], [np.linalg.norm(a - b) / longest, *(level @ flat @ a - [1, 0, 0]) / longest], atol=1e-6)
        assert all(r["features"] == [0.0] * 4 for r in rows[len(want) :]) and max(r["features"][0] for r in rows) == 1
