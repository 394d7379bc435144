"""Orders of graphs against a sequential version, and noise against its moments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldweave.functions import noise
from fieldweave.operators import meshes, ordering
from fieldweave.plans.catalogue import QUERIES
from fieldweave.sources.tables import ship

SF = "/root/testdata/sf0.001"


def in_turn(edges):
    """One queue: the next component starts at the least (degree, node); each node appends its new neighbours by (degree, node)."""
    near = {}
    for u, v in edges:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    near = {u: vs - {u} for u, vs in near.items()}
    weight = lambda u: (len(near[u]), u)
    queue, seen = [], set()
    for start in sorted(near, key=weight):
        if start in seen:
            continue
        seen.add(start)
        at = len(queue)
        queue.append(start)
        while at < len(queue):
            new = sorted(near[queue[at]] - seen, key=weight)
            seen.update(new)
            queue += new
            at += 1
    return {u: len(queue) - 1 - i for i, u in enumerate(queue)}


def mesh_edges():
    _, levels = meshes.hierarchy(2)
    return [(int(a), int(b)) for f in levels[-1] for a, b in zip(f, np.roll(f, 1), strict=True)]


@pytest.mark.parametrize("edges", [mesh_edges(), [(5, 1), (1, 5), (7, 7), (2, 3), (3, 9), (9, 2), (9, 4), (8, 6)]], ids=["mesh", "components"])
def test_banded_order(spark, edges):
    table = spark.createDataFrame([*edges, (None, 1)], "sender long, receiver long")
    found = {r["node"]: r["position"] for r in ordering.banded_order(table).collect()}
    assert found == in_turn(edges)
    if len(edges) > 100:
        band = lambda at: max(abs(at[u] - at[v]) for u, v in edges)
        assert band(found) < band({u: u for u in found}) / 2


def test_banded_order_of_nothing(spark):
    assert ordering.banded_order(spark.createDataFrame([], "sender long, receiver long")).count() == 0


def test_banded_queries(spark):
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_partkey", "l_suppkey").collect()
    want = in_turn([(2 * p, 2 * s + 1) for p, s in rows])
    assert {r["node"]: r["position"] for r in QUERIES["banded_nodes"](spark, SF).collect()} == want
    edges = {(r["sender_position"], r["receiver_position"]) for r in QUERIES["banded_edges"](spark, SF).collect()}
    assert edges == {(want[2 * p], want[2 * s + 1]) for p, s in rows}


def test_harmonics():
    draw = np.random.default_rng(1)
    z, lon = draw.uniform(-1, 1, 20000), draw.uniform(0, 360, 20000)
    y = noise.harmonics(np.degrees(np.arcsin(z)), lon, 6)
    for n in range(6):  # the squares of a degree add up to a constant
        assert np.allclose((y[:, n * n : (n + 1) ** 2] ** 2).sum(axis=1), 2 * n + 1)
    assert np.abs(y.T @ y / len(z) - np.eye(36)).max() < 0.1
    assert np.allclose(y[:, 2], np.sqrt(3) * z)


def test_isotropic_noise(spark):
    ship(spark)
    power = [0.0, 0.5, 0.3, 0.2]
    rows = spark.range(4000).select(F.col("id").alias("draw"), F.lit(35.0).alias("lat"), F.lit(120.0).alias("lon"))
    value = noise.isotropic(F.col("lat"), F.col("lon"), noise.key_of(1, F.col("draw")), power).alias("x")
    found = {r["draw"]: r["x"] for r in rows.select("draw", value).collect()}
    x = np.array(list(found.values()))
    assert abs(x.mean()) < 0.06 and abs(x.var() - 1) < 0.1
    assert {r["draw"]: r["x"] for r in rows.repartition(3).select("draw", value).collect()} == pytest.approx(found)
    assert rows.limit(1).select(noise.isotropic(F.lit(None).cast("double"), F.col("lon"), noise.key_of(1, F.col("draw")), power)).first()[0] is None


def test_white_noise(spark):
    rows = spark.range(20000).select(noise.normal(noise.key_of(3, F.col("id"))).alias("x"))
    mean, var = rows.agg(F.avg("x"), F.var_pop("x")).first()
    assert abs(mean) < 0.03 and abs(var - 1) < 0.05


def test_quantiles(spark):
    rng = np.random.default_rng(4)
    values = {"a": rng.integers(-9, 9, 501).astype(float), "b": rng.random(300), "c": np.array([2.5])}
    rows = [(k, float(x)) for k, some in values.items() for x in some] + [("a", None), ("d", None)]
    found = {r["k"]: r for r in ordering.quantiles(spark.createDataFrame(rows, "k string, v double"), "k", "v", {"low": 0.02, "high": 0.98}).collect()}
    assert set(found) == {"a", "b", "c", "d"} and found["d"]["low"] is None and found["d"]["high"] is None
    for k, some in values.items():
        assert np.allclose([found[k]["low"], found[k]["high"]], np.quantile(some, [0.02, 0.98]))


def test_robust_scales_gathers_no_values(spark):
    assert "percentile" not in QUERIES["robust_scales"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString().lower()


def test_components_of_dense_links(spark):
    """Chains whose least neighbours make many small groups, and a dense part: roots as by the plain rounds."""
    from fieldweave.operators.components import components, components_of_dense

    draw = np.random.default_rng(6)
    edges = {(int(a), int(b)) for a, b in draw.integers(0, 300, (240, 2)) if a != b} | {(1000 + i, 1001 + i) for i in range(40)} | {(2000 + 7 * i % 64, 2000 + 7 * (i + 1) % 64) for i in range(63)}
    links = spark.createDataFrame([*edges, *[(b, a) for a, b in edges]], "u long, v long").distinct()
    plain = lambda rows: sorted(map(tuple, rows.collect()))
    assert plain(components_of_dense(links)) == plain(components(links)) != []


def test_rounds_run_on_few_links(spark, monkeypatch):
    """A dense graph: the rounds of components see a link a node, and what is left between groups, but never all links."""
    from fieldweave.operators import components as module

    seen, plain = [], module.components
    monkeypatch.setattr(module, "components", lambda edges: seen.append(edges.distinct().count()) or plain(edges))
    edges = spark.createDataFrame([(2 * i, 2 * j + 1) for i in range(60) for j in range(40)], "sender long, receiver long")
    assert ordering.banded_order(edges).count() == 100
    assert seen and max(seen) <= 100
