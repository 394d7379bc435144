"""The auction against the Hungarian method, and that against all permutations."""

from itertools import permutations

import numpy as np
import pytest

from fieldweave.operators import cyclones, matching, pricing
from fieldweave.operators.cyclones import matched
from fieldweave.operators.matching import auction
from fieldweave.operators.neighbours import _km
from fieldweave.operators.pricing import Places, best_pairs, missed
from fieldweave.plans.catalogue import QUERIES
from test_gridding import km


def _assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of least total cost, as many as the shorter side has (the Hungarian method)."""
    if cost.shape[0] > cost.shape[1]:
        return [(i, j) for j, i in _assign(cost.T)]
    n, m = cost.shape
    u, v, row_of = np.zeros(n), np.zeros(m + 1), np.full(m + 1, -1)
    for i in range(n):
        row_of[m], at = i, m
        least, came, done = np.full(m, np.inf), np.full(m, m), np.zeros(m + 1, bool)
        while row_of[at] >= 0:
            done[at] = True
            slack = cost[row_of[at]] - u[row_of[at]] - v[:m]
            better = ~done[:m] & (slack < least)
            least[better], came[better] = slack[better], at
            to = int(np.argmin(np.where(done[:m], np.inf, least)))
            step = least[to]
            u[row_of[done]] += step
            v[done] -= step
            least[~done[:m]] -= step
            at = to
        while at != m:
            row_of[at], at = row_of[came[at]], came[at]
    return [(int(i), j) for j, i in enumerate(row_of[:m]) if i >= 0]


@pytest.mark.parametrize("seed", range(30))
def test_least_cost(seed):
    rng = np.random.default_rng(seed)
    n, m = rng.integers(1, 6, 2).tolist()
    cost = rng.integers(0, 6, (n, m)).astype(float) if seed % 2 else rng.random((n, m))
    pairs = _assign(cost)
    assert len(pairs) == min(n, m) == len({i for i, _ in pairs}) == len({j for _, j in pairs})
    tall = cost if n <= m else cost.T
    least = min(sum(tall[i, j] for i, j in enumerate(p)) for p in permutations(range(max(n, m)), min(n, m)))
    assert abs(sum(cost[i, j] for i, j in pairs) - least) < 1e-9


def test_query(spark):
    rows = QUERIES["matched_tracks"](spark, "/root/testdata/sf0.001").collect()
    assert rows and len({(r["step"], r["track_id"]) for r in rows}) == len({(r["step"], r["match_id"]) for r in rows}) == len(rows)


@pytest.mark.parametrize("block", [1 << 18, 60])
def test_auctions_save_as_much_as_whole_steps(spark, monkeypatch, block):
    """The savings of all pairs of a step, settled by one block or in rounds of several, against one dense matrix of the step."""
    monkeypatch.setattr(matching, "FINER", 8 if block > 1000 else 200)  # fewer rounds
    draw = np.random.default_rng(4)
    rows = lambda seed: [(s, i, float(draw.uniform(-25, 25)), float(draw.uniform(0, 60) % 360)) for s in range(3) for i in range(40)]
    a, b = rows(1), rows(2)
    frame = lambda r: spark.createDataFrame(r, "step long, track_id long, lat double, lon double")
    found = matched(frame(a), frame(b), 500.0, block).collect()
    assert len({(r["step"], r["track_id"]) for r in found}) == len({(r["step"], r["match_id"]) for r in found}) == len(found) > 20
    for step in range(3):
        left, right = [[r for r in t if r[0] == step] for t in (a, b)]
        cost = np.array([[km(*x[2:], *y[2:]) for y in right] for x in left])
        assert all(abs(cost[r["track_id"], r["match_id"]] - r["km"]) < 1e-6 and r["km"] < 500 for r in found if r["step"] == step)
        best = sum(500 - min(500, cost[i, j]) for i, j in _assign(np.minimum(cost, 500.0)))
        assert sum(500 - r["km"] for r in found if r["step"] == step) == pytest.approx(best, abs=0.05)
    assert matched(frame([]), frame(b)).count() == 0


@pytest.mark.parametrize("block, unit", [(1 << 18, 1), (150, 500)])
def test_ties_and_price_wars(spark, monkeypatch, block, unit):
    """Many who want the same few, at equal and at almost equal distances."""
    monkeypatch.setattr(matching, "FINER", 8 if block > 1000 else 200)
    rng = np.random.default_rng(7)
    groups = {0: np.full((9, 4), 1000), 1: rng.integers(0, 3, (12, 12)) * 300, 2: rng.integers(0, 100_000, (15, 6)), 3: np.array([[5]]), 4: np.add.outer(np.arange(10), np.arange(10)) * 10}
    groups, most = {g: cost // unit for g, cost in groups.items() if unit == 1 or g in (0, 2, 3)}, 100_000 // unit
    pairs = [(g, i, j + 100, int(d)) for g, cost in groups.items() for i, row in enumerate(cost) for j, d in enumerate(row) if d < 0.9 * most]
    found = auction(spark.createDataFrame(pairs, "group long, left long, right long, metres long"), most, block).collect()
    for g, cost in groups.items():
        own = [(r["left"], r["right"] - 100) for r in found if r["group"] == g]
        assert len({i for i, _ in own}) == len({j for _, j in own}) == len(own)
        saved = np.where(cost < 0.9 * most, most - cost, 0)
        assert sum(saved[p] for p in own) == sum(saved[p] for p in _assign(-saved.astype(float)))


@pytest.mark.parametrize("seed", range(20))
def test_pairs_that_prices_ask_for(seed):
    """Few pairs are made, and yet the savings are those of all near pairs, in whole metres; at equal places too."""
    rng = np.random.default_rng(seed)
    n, m = rng.integers(1, 70, 2)
    wide, most = (0.5, 5, 25, 60)[seed % 4], (500, 1000, 3000)[seed % 3]
    side = lambda k: (rng.integers(-5, 5, k).astype(float), rng.integers(-5, 5, k) % 360.0) if seed % 5 == 0 else (rng.uniform(-wide, wide, k), rng.uniform(0, 2 * wide, k) % 360)
    a, b = side(n), side(m)
    i, j = best_pairs(*a, *b, float(most))
    far = _km(a[0][:, None], a[1][:, None], *b)
    saved = np.where(far < most, most * 1000 - np.minimum(np.floor(far * 1000 + 0.5), most * 1000), 0)
    assert len(set(i)) == len(set(j)) == len(i) and (far[i, j] < most).all()
    assert saved[i, j].sum() == sum(saved[p] for p in _assign(-saved))


def test_a_dense_step_writes_no_row_a_pair(spark, monkeypatch):
    """400 fixes against 380, all of them near each other, some at equal places: what is written grows with the fixes."""
    rng, written = np.random.default_rng(3), []
    for module in (cyclones, matching):
        keep = module.kept
        monkeypatch.setattr(module, "kept", lambda df, *args, _keep=keep, **more: written.append(_keep(df, *args, **more)) or written[-1])
    rows = lambda k: [(1, i, float(rng.integers(0, 30)) / 20, float(rng.integers(0, 30)) / 20) for i in range(k)]
    a, b = rows(400), rows(380)
    frame = lambda r: spark.createDataFrame(r, "step long, track_id long, lat double, lon double")
    found = matched(frame(a), frame(b), 500.0).collect()
    assert max(t.count() for t in written) <= 780
    far = _km(*[np.array([r[k] for r in a])[:, None] for k in (2, 3)], *[np.array([r[k] for r in b]) for k in (2, 3)])
    assert len({r["track_id"] for r in found}) == len({r["match_id"] for r in found}) == len(found) == 380
    assert all(abs(far[r["track_id"], r["match_id"]] - r["km"]) < 1e-6 for r in found)
    assert sum(r["km"] for r in found) == pytest.approx(sum(far[p] for p in _assign(far)), abs=0.05)


@pytest.mark.parametrize("seed", range(4))
def test_fixes_at_one_place_bid_together(monkeypatch, seed):
    """Hundreds of fixes at a few places: pairs are offered by places, and the savings are those of all pairs of fixes."""
    rng, offered, keep = np.random.default_rng(seed), [], pricing._Auction.offer
    monkeypatch.setattr(pricing._Auction, "offer", lambda self, *pairs: offered.append(len(pairs[0])) or keep(self, *pairs))
    side = lambda k: (rng.integers(-2, 3, k) * 3.0, rng.integers(-3, 4, k) * 3 % 360.0)
    a, b = side(260), side(240 + 40 * (seed % 2))
    i, j = best_pairs(*a, *b, 900.0)
    far = _km(a[0][:, None], a[1][:, None], *b)
    saved = np.where(far < 900, 900_000 - np.minimum(np.floor(far * 1000 + 0.5), 900_000), 0)
    assert len(set(i)) == len(set(j)) == len(i) and (far[i, j] < 900).all()
    assert saved[i, j].sum() == sum(saved[p] for p in _assign(-saved))
    assert max(offered) <= 35 * 35


@pytest.mark.parametrize("margin", [0, 40_000, 3_000_000])
def test_watched_pairs_are_all_that_prices_miss(margin):
    """Prices that rise and fall: what is watched finds the pairs that a search of all cells finds."""
    rng = np.random.default_rng(margin)
    left, right = (Places(rng.uniform(-40, 40, k), rng.uniform(0, 90, k)) for k in (300, 250))
    u, v, scale = rng.integers(0, 900_000, 300) * 7, rng.integers(0, 900_000, 250) * 7, 7
    watch, found = pricing._Watch(left, right, scale, 800.0, margin * scale), 0
    for rise in (500, 300, 100, 20, 1, 1):
        x, y, gain, excess = watch.missed(u, v, rise)
        i, j, more, least = missed(left, right, u, v, scale, rise, 800.0, None)
        assert sorted(zip(x, y, gain, excess, strict=True)) == sorted(zip(i, j, more, least, strict=True))
        found += len(x)
        u, v = (np.maximum(0, p + rng.integers(-60_000, 50_000, len(p)) * scale * (rng.random(len(p)) < 0.5)) for p in (u, v))
    assert found > 100
