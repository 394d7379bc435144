"""Matching of places at the least cost without a row for each near pair: only pairs that prices ask for are made.

The auction (see `matching`) starts from each place's nearest ones. What it leaves are prices: u of a left and v of a right,
none below 0, whose sum is a pair's gain where the pair is taken. A pair of greater gain than u + v would have been missed, so
such pairs are searched for in space, cell against cell, up to the distance that the prices of both cells allow; the auction
goes on with them from where it was. Fixes at one place bid and are bid for together, so the work grows with the places; pairs that
are far from being taken are let go, once a phase, and come back where they are missed. When none is left, u and v bound the gain of all matchings of all near pairs, and the
matching found is at less than one metre from that bound: it is the best in whole metres."""

from __future__ import annotations

import numpy as np

from ..functions.geo import EARTH_KM
from .neighbours import CELL_PLACES, HELD, _km, _unit

#: Nearest places of the first lists; pairs a place adds at once; by how much a phase is finer than the one before; up to how many
#: bidders bid one by one; what a round of lowering costs besides its looks at pairs.
FIRST, ADDED, FINER, FEW, ROUND = 12, 8, 5, 48, 2000
#: Pairs that lack as much of being missed as places lie apart are watched and stay offered; so are those that lack this many rises.
AROUND = 60

_LOW = -(1 << 62)


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _different(values: np.ndarray) -> np.ndarray:
    """Sorted, without repeats."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _least(key: np.ndarray, value: np.ndarray, k: int) -> np.ndarray:
    """Which rows are among the k least of their key."""
    order = np.lexsort((value, key))
    starts = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])) if len(key) else np.empty(0, int)
    rank = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
    out = np.zeros(len(key), bool)
    out[order[rank < k]] = True
    return out


class Places:
    """Places of a sphere in small cells."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray):
        self.lat, self.lon, self.at = lat, lon, _unit(lat, lon)
        side = min(max(np.sqrt(CELL_PLACES * 4 * np.pi / max(len(lat), 1)), 1e-4), 2.0)
        cell = np.floor((self.at + 1) / side).astype(np.int64)
        _, cell = np.unique((cell[:, 0] << 42) + (cell[:, 1] << 21) + cell[:, 2], return_inverse=True)
        self.order, self.sizes = np.argsort(cell, kind="stable"), np.bincount(cell)
        self.starts = np.cumsum(self.sizes) - self.sizes
        inner = self.at[self.order]
        self.middle = np.add.reduceat(inner, self.starts) / self.sizes[:, None]
        self.extent = np.maximum.reduceat(np.linalg.norm(inner - np.repeat(self.middle, self.sizes, axis=0), axis=1), self.starts)


def gains(left: Places, right: Places, i: np.ndarray, j: np.ndarray, most_km: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of the pairs that are nearer than most_km, and the whole metres by which they are."""
    km = _km(left.lat[i], left.lon[i], right.lat[j], right.lon[j])
    near = km < most_km
    most = int(most_km * 1000)
    return i[near], j[near], most - np.minimum(np.floor(km[near] * 1000 + 0.5).astype(np.int64), most)


def _around(a: Places, b: Places, k: int, cap: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """About the k nearest of b for each of a, from the cells next to it. A first guess: nothing depends on it but time."""
    side = min(max(np.sqrt(k * 4 * np.pi / 3 / max(len(a.at), len(b.at))), 1e-5), 2.0)
    width = int(2 / side) + 4
    key = lambda c: (c[:, 0] * width + c[:, 1]) * width + c[:, 2]
    cell = lambda p: np.floor((p.at + 1) / side).astype(np.int64) + 1
    there = key(cell(b))
    order = np.argsort(there, kind="stable")
    there, here, found = there[order], cell(a), []
    for some in np.array_split(np.arange(len(here)), len(here) // 16384 + 1):
        i, j = [], []
        for x in (-1, 0, 1):
            for y in (-1, 0, 1):
                base = key(here[some] + np.array([x, y, 0]))
                start, end = np.searchsorted(there, base - 1, "left"), np.searchsorted(there, base + 1, "right")
                size = np.minimum(end - start, cap)
                i.append(np.repeat(some, size))
                j.append(order[_spans(start, size)])
        i, j = np.concatenate(i), np.concatenate(j)
        near = _least(i, ((a.at[i] - b.at[j]) ** 2).sum(axis=1), k)
        found.append((i[near], j[near]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def nearest(left: Places, right: Places, most_km: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs to begin with, and their gains."""
    (i, j), (y, x) = _around(left, right, FIRST), _around(right, left, FIRST)
    pairs = np.unique(np.append(i, x) * len(right.lat) + np.append(j, y))
    return gains(left, right, pairs // len(right.lat), pairs % len(right.lat), most_km)


def missed(left: Places, right: Places, u: np.ndarray, v: np.ndarray, scale: int, rise: int, most_km: float, added: int | None = ADDED, of: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Pairs (left, right, gain, excess) whose gain * scale is above (u + v) / 2 + rise, the `added` worst of a left in a cell at
    least, of all lefts or of some. None if there are none."""
    in_km = 2000.0 * scale
    a, b, low_u, low_v = left.at[left.order], right.at[right.order], u[left.order] / in_km, v[right.order] / in_km
    least_u, least_v = np.minimum.reduceat(low_u, left.starts), np.minimum.reduceat(low_v, right.starts)
    slack, out = 2e-3 - min(rise, 0) / (1000.0 * scale), []  # km that the distances below may be wrong by, or off
    chords = lambda km: 2 * np.sin(np.clip(km, 0, np.pi * EARTH_KM) / EARTH_KM / 2)
    for g, start in enumerate(left.starts):
        mine = np.arange(start, start + left.sizes[g])
        if of is not None:
            mine = mine[of[left.order[mine]]]
            if not len(mine):
                continue
        reach = chords(most_km + slack - least_u[g] - least_v)
        apart = np.sqrt(((right.middle - left.middle[g]) ** 2).sum(axis=1))
        cells = np.flatnonzero(apart - left.extent[g] - right.extent <= reach + 1e-7)
        rim = _spans(right.starts[cells], right.sizes[cells])
        for some in np.array_split(mine, len(mine) * len(rim) // HELD + 1) if len(rim) else ():
            square = np.clip((1 - a[some] @ b[rim].T) / 2, 0, 1)
            worth = most_km + slack - low_u[some, None] - low_v[rim]
            i, j = np.nonzero((worth > 0) & (square <= (chords(worth) / 2) ** 2 + 1e-15))
            i, j, gain = gains(left, right, left.order[some[i]], right.order[rim[j]], most_km)
            excess = 2 * (gain * scale - rise) - u[i] - v[j]
            worst = excess > 0
            i, j, gain, excess = i[worst], j[worst], gain[worst], excess[worst]
            if added and len(i) > added * len(some):
                worst = _least(i, -excess, added)
                i, j, gain, excess = i[worst], j[worst], gain[worst], excess[worst]
            out.append((i, j, gain, excess // 2))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 4


class _Watch:
    """What `missed` finds, time and again: pairs that lack less than a margin of being missed are kept, and others are searched for
    only from places whose price has fallen by more than that since they were searched last. A pair lacks half of what both
    prices, which are twice as much, are above its gain, so one of the two must have fallen by that."""

    def __init__(self, left: Places, right: Places, scale: int, most_km: float, margin: int):
        self.left, self.right, self.scale, self.most_km, self.margin, self.u = left, right, scale, most_km, margin, None

    def missed(self, u: np.ndarray, v: np.ndarray, rise: int) -> tuple[np.ndarray, ...]:
        m = len(self.right.lat)
        if self.u is None:
            self.u, self.v, self.keys, self.gain = u.copy(), v.copy(), np.empty(0, np.int64), np.empty(0, np.int64)
            fell = np.ones(len(u), bool), np.zeros(m, bool)
        else:
            fell = self.u - u > self.margin, self.v - v > self.margin
        for k, (mine, now) in enumerate(((self.u, u), (self.v, v))):
            mine[fell[k]] = now[fell[k]]
        for k, some in enumerate(fell):
            if some.any():
                sides = (self.left, self.right, self.u, self.v) if k == 0 else (self.right, self.left, self.v, self.u)
                x, y, gain, _ = missed(*sides, self.scale, -self.margin, self.most_km, None, some)
                self.keys, first = np.unique(np.append(self.keys, x * m + y if k == 0 else y * m + x), return_index=True)
                self.gain = np.append(self.gain, gain)[first]
        i, j = self.keys // m, self.keys % m
        excess = 2 * (self.gain * self.scale - rise) - u[i] - v[j]
        some = np.flatnonzero(excess > 0)
        return i[some], j[some], self.gain[some], excess[some] // 2


class _Auction:
    """Places that hold several fixes bid for them all, and what a place offers has one price. Bidders are lefts and then copies
    of rights, objects rights and then copies of lefts, as in `matching`; a pair is a flow of fixes."""

    def __init__(self, lefts: np.ndarray, rights: np.ndarray, scale: int):
        self.n, self.m, self.scale = len(lefts), len(rights), scale
        self.supply, self.room = np.append(lefts, rights), np.append(rights, lefts)
        self.price, self.keys = np.zeros(self.n + self.m, np.int64), np.empty(0, np.int64)
        self.flow = np.zeros(self.n + self.m, np.int64)
        self.order = np.arange(self.n + self.m)

    def flows(self) -> list[np.ndarray]:
        """Flows of pairs, of lefts that stay alone, of pairs of copies, and of rights that stay alone."""
        flow, pairs = np.empty_like(self.flow), len(self.keys)
        flow[self.order] = self.flow
        return np.split(flow, np.cumsum([pairs, self.n, pairs]))

    def held(self) -> np.ndarray:
        """Which of the offered pairs are taken by a fix or by a copy of one."""
        flows = self.flows()
        return flows[0] + flows[2] > 0

    def offer(self, keys: np.ndarray, gain: np.ndarray) -> None:
        """Pairs, left * number of rights + right, in order and without repeats, those that are taken among them."""
        n, m = self.n, self.m
        flows, (i, j) = self.flows(), np.divmod(keys, m)
        was = np.flatnonzero(flows[0] + flows[2])
        to = np.searchsorted(keys, self.keys[was])
        for k in (0, 2):
            flow = np.zeros(len(keys), np.int64)
            flow[to] = flows[k][was]
            flows[k] = flow
        by = np.concatenate([i, np.arange(n), n + j, n + np.arange(m)])
        self.keys, self.order = keys, np.argsort(by, kind="stable")
        self.by, self.to = by[self.order], np.concatenate([j, m + np.arange(n), m + i, np.arange(m)])[self.order]
        self.gain = np.concatenate([gain, np.zeros(n, np.int64), gain, np.zeros(m, np.int64)])[self.order] * self.scale
        self.flow = np.concatenate(flows)[self.order]
        self.sizes, self.in_sizes, self.in_order = np.bincount(by, minlength=n + m), np.bincount(self.to, minlength=n + m), np.argsort(self.to, kind="stable")
        self.starts, self.in_starts = np.cumsum(self.sizes) - self.sizes, np.cumsum(self.in_sizes) - self.in_sizes
        self.lists = None

    def suits(self, rise: int, looks: int = 2) -> bool:
        """Whether prices are found, by lowering those of objects that their bidders would give back, at which all keep theirs."""
        price, who, looks = self.price.copy(), np.arange(len(self.starts)), looks * len(self.by)
        while looks > 0:
            sizes = self.sizes[who]
            looks -= int(sizes.sum()) + ROUND
            offers = _spans(self.starts[who], sizes)
            to, gain, held = self.to[offers], self.gain[offers], self.flow[offers] > 0
            best = np.maximum.reduceat(gain - price[to], np.cumsum(sizes) - sizes)
            most = gain + rise - np.repeat(best, sizes)
            low = held & (most < price[to])
            if not low.any():
                self.price = price
                return True
            np.minimum.at(price, to[low], most[low])
            at = _different(to[low])
            who = _different(self.by[self.in_order[_spans(self.in_starts[at], self.in_sizes[at])]])
        return False

    def settle(self, rise: int) -> None:
        """Frees fixes whose object is worth less than the best by more than rise, and lets the free ones bid until all have one."""
        if self.flow.any() and self.suits(rise):
            return
        price, flow, by, to, gain, room = self.price, self.flow, self.by, self.to, self.gain, self.room
        worth = gain - price[to]
        flow[worth < np.maximum.reduceat(worth, self.starts)[by] - rise] = 0
        limit = price[to]  # what the fixes of a flow would pay
        free = self.supply - np.add.reduceat(flow, self.starts)
        who = np.flatnonzero(free)
        while len(who) > FEW:  # all at once
            sizes = self.sizes[who]
            offers, starts = _spans(self.starts[who], sizes), np.cumsum(sizes) - sizes
            worth = gain[offers] - price[to[offers]]
            best = np.maximum.reduceat(worth, starts)
            top = np.flatnonzero(worth == np.repeat(best, sizes))
            own = np.repeat(np.arange(len(who)), sizes)[top]
            top = top[np.append(True, own[1:] != own[:-1])]
            worth[top] = _LOW
            second = np.maximum.reduceat(worth, starts)
            top = offers[top]
            at = to[top]
            limit[top] = np.maximum(limit[top], price[at] + rise + np.where(second == _LOW, 0, best - second))
            units = np.minimum(free[who], room[at])
            flow[top] += units
            free[who] -= units
            # What is asked for goes to those who would pay most.
            at = _different(at)
            asked = self.in_order[_spans(self.in_starts[at], self.in_sizes[at])]
            asked = asked[flow[asked] > 0]
            asked = asked[np.lexsort((-limit[asked], to[asked]))]
            there = to[asked]
            first = np.flatnonzero(np.append(True, there[1:] != there[:-1]))
            units, numbers = flow[asked], np.diff(np.append(first, len(there)))
            before = np.cumsum(units) - units
            before -= np.repeat(before[first], numbers)
            left = np.clip(room[there] - before, 0, units)
            full = before + units >= room[there]
            last = np.flatnonzero(full & (left > 0))  # one for each that is full
            price[there[last]] = limit[asked[last]]
            out = np.flatnonzero(left < units)
            flow[asked[out]] = left[out]
            np.add.at(free, by[asked[out]], units[out] - left[out])
            who = _different(np.append(who, by[asked[out]]))
            who = who[free[who] > 0]
        if len(who):
            self._one_by_one(rise, who.tolist(), free, limit)

    def _one_by_one(self, rise: int, who: list[int], free: np.ndarray, limit: np.ndarray) -> None:
        """The bids of a few, in plain lists."""
        if self.lists is None:
            self.lists = [c.tolist() for c in (self.by, self.to, self.gain, np.append(self.starts, len(self.by)), np.append(self.in_starts, len(self.by)), self.room)]
        by, to, gain, starts, in_starts, room = self.lists
        price, free, flow, most, holders, held = self.price.tolist(), free.tolist(), {}, {}, {}, {}
        while who:
            i = who.pop()
            best = second = _LOW
            for k in range(starts[i], starts[i + 1]):
                worth = gain[k] - price[to[k]]
                if worth > best:
                    best, second, top = worth, best, k
                elif worth > second:
                    second = worth
            at = to[top]
            mine = holders.get(at)
            if mine is None:
                asked = self.in_order[in_starts[at] : in_starts[at + 1]]
                mine = holders[at] = asked[self.flow[asked] > 0].tolist()
                for k in mine:
                    flow[k], most[k] = int(self.flow[k]), int(limit[k])
                held[at] = sum(flow[k] for k in mine)
            units = min(free[i], room[at])
            level = price[at] + rise + (0 if second == _LOW else best - second)
            if flow.get(top):
                flow[top] += units
                most[top] = max(most[top], level)
            else:
                flow[top], most[top] = units, level
                mine.append(top)
            free[i] -= units
            if free[i]:
                who.append(i)
            over = held[at] + units - room[at]
            if over < 0:
                held[at] += units
                continue
            held[at] = room[at]
            if len(mine) > 1:
                mine.sort(key=most.__getitem__, reverse=True)
            while over:
                k = mine[-1]
                out = min(flow[k], over)
                flow[k] -= out
                over -= out
                if not free[by[k]]:
                    who.append(by[k])
                free[by[k]] += out
                if not flow[k]:
                    mine.pop()
            price[at] = most[mine[-1]]
        self.price[:] = price
        self.flow[list(flow)] = list(flow.values())

    def duals(self) -> tuple[np.ndarray, np.ndarray]:
        """Twice the prices u of the lefts and v of the rights: both copies' together, so that no level is left open."""
        worth = np.maximum.reduceat(self.gain - self.price[self.to], self.starts)
        return worth[: self.n] + self.price[self.m :], worth[self.n :] + self.price[: self.m]


def _at_places(lat: np.ndarray, lon: np.ndarray) -> tuple[Places, np.ndarray, np.ndarray]:
    """Places without repeats, the fixes at each one after the other, and their numbers."""
    at = np.empty(len(lat), complex)
    at.real, at.imag = lat, lon
    at, place, sizes = np.unique(at, return_inverse=True, return_counts=True)
    return Places(at.real.copy(), at.imag.copy()), np.argsort(place, kind="stable"), sizes


def _dealt(place: np.ndarray, units: np.ndarray, fixes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The fixes of flows from or to places: each flow takes the next ones of its place."""
    order = np.argsort(place, kind="stable")
    before = np.cumsum(units[order]) - units[order]
    first = np.append(True, place[order][1:] != place[order][:-1]) if len(place) else np.empty(0, bool)
    before -= before[first][np.cumsum(first) - 1]
    start = np.empty(len(place), np.int64)
    start[order] = (np.cumsum(sizes) - sizes)[place[order]] + before
    return fixes[_spans(start, units)]


def best_pairs(lat0: np.ndarray, lon0: np.ndarray, lat1: np.ndarray, lon1: np.ndarray, most_km: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of both sides, one to one and nearer than most_km, whose sum of (most_km - km), in whole metres, is the greatest.

    Prices are checked by pairs not yet made once they are as fine as 10 km, and for good in the last phase."""
    if not len(lat0) or not len(lat1):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    (left, fixes0, sizes0), (right, fixes1, sizes1) = _at_places(lat0, lon0), _at_places(lat1, lon1)
    n, m, scale = len(sizes0), len(sizes1), 2 * (len(lat0) + len(lat1)) + 1
    i, j, gain = nearest(left, right, most_km)
    keys, auction, phases = i * m + j, _Auction(sizes0, sizes1, scale), [1]
    auction.offer(keys, gain)
    while phases[-1] * FINER < most_km * 1000 * scale / 20:
        phases.append(phases[-1] * FINER)
    at = lowest = len(phases) - 1
    watch, apart = None, int(EARTH_KM * 1000 * np.sqrt(4 * np.pi / (n + m))) * scale
    while at >= 0:
        auction.settle(phases[at])
        if at and phases[at] < 10 * scale and auction.suits(1, 8):
            at = 0
        if not watch and at and phases[at] >= 10_000 * scale:
            at -= 1
            continue
        u, v = auction.duals()
        x, y, more, excess = watch.missed(u, v, phases[at]) if watch else missed(left, right, u, v, scale, phases[at], most_km)
        held = np.ones(len(keys), bool)  # and none of these is missed
        if len(x) > 2 * (n + m):
            some = _least(x, -excess, FIRST) | _least(y, -excess, FIRST)
            x, y, more = x[some], y[some], more[some]
        if not watch and len(x) < (n + m) // 4:
            watch = _Watch(left, right, scale, most_km, apart)
            watch.missed(u, v, phases[at])
        if len(x):
            while at < len(phases) - 1 and phases[at] < int(excess.max()) / 40:
                at += 1
        else:
            at -= 1
        if 0 <= at < lowest:
            lowest, held = at, auction.held() | (2 * (gain * scale + max(AROUND * phases[at], apart)) > u[keys // m] + v[keys % m])
        x = x * m + y
        keys, first = np.unique(np.concatenate([keys[held], x]), return_index=True)
        gain = np.append(gain[held], more)[first]
        if at >= 0:
            auction.offer(keys, gain)
    flow = auction.flows()[0]
    taken = np.flatnonzero(flow)
    i, j = np.divmod(auction.keys[taken], m)
    return _dealt(i, flow[taken], fixes0, sizes0), _dealt(j, flow[taken], fixes1, sizes1)
