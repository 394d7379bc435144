"""Cyclone tracking on gridded probabilities of existence: a fold over each run's frames.

Each run's cells with p > 0 are sorted by step where the run lies, and a task walks through them once with the run's
centres as state: it holds the cells of one frame, never a run, and no step costs a job. Runs advance beside each other. A
lost executor repeats its runs from the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geo import EARTH_KM
from ..sources.tables import ship
from . import cyclones


@dataclass(frozen=True)
class Settings:
    """Distances in km, thresholds, and the number of steps that a new track must outlast. Defaults are those of 6-hour fields.

    A centre moves to the `mode` of its disc, the `mean`, or to one and then the other (`mode_then_mean`)."""

    cell: float = 1.0
    mode_km: float = 250.0
    mean_km: float = 250.0
    existence_km: float = 500.0
    refinement_km: float = 250.0
    scalar_km: float = 250.0
    apart_km: float = 500.0
    prune_km: float = 500.0
    box: float = 5.0
    box_threshold: float = 0.3
    least_existence: float = 1e-5
    momentum: float = 0.9
    mode: str = "mode_then_mean"
    existence_scale: float = 1.0
    most_lat: float = 80.0
    least_steps: int = 10


def _xyz(lat: float | np.ndarray, lon: float | np.ndarray) -> np.ndarray:
    a, b = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)])


def _place(x: np.ndarray) -> tuple[float, float]:
    return float(np.degrees(np.arctan2(x[2], np.hypot(x[0], x[1])))), float(np.degrees(np.arctan2(x[1], x[0])) % 360)


def _km(lat: float, lon: float, lats: np.ndarray, lons: np.ndarray) -> np.ndarray:
    a, b, c, d = (np.radians(v) for v in (lat, lon, lats, lons))
    h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 2 * EARTH_KM * np.arcsin(np.minimum(1.0, np.sqrt(h)))


def guess(lat: float, lon: float, was: tuple[float, float] | None, momentum: float) -> tuple[float, float]:
    """Where a track goes next: on along its great circle; without a position before, where it is."""
    if was is None:
        return lat, lon
    now, before = _xyz(lat, lon), _xyz(*was)
    angle = 2 * np.arcsin(min(1.0, np.linalg.norm(now - before) / 2))
    if angle < 1e-9:
        return lat, lon
    return _place(np.cos(angle * momentum) * now + np.sin(angle * momentum) * (now * np.cos(angle) - before) / np.sin(angle))


class Frame:
    """The cells of one step with p > 0, in order of latitude and longitude, and the number of all its cells."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, p: np.ndarray, scalars: np.ndarray, cells: int):
        order = np.lexsort((lon, lat))
        self.lat, self.lon, self.p, self.scalars, self.cells = lat[order], lon[order], p[order], scalars[:, order], cells
        self.xyz = _xyz(self.lat, self.lon)

    def disc(self, lat: float, lon: float, km: float) -> np.ndarray:
        """The places of the cells nearer than km."""
        reach = np.degrees(km / EARTH_KM) + 1e-6
        first, last = np.searchsorted(self.lat, [lat - reach, lat + reach])
        near = first + np.flatnonzero(_xyz(lat, lon) @ self.xyz[:, first:last] > np.cos(min(np.pi, km / EARTH_KM)) - 1e-9)
        return near[_km(lat, lon, self.lat[near], self.lon[near]) < km]

    def mean(self, lat: float, lon: float, km: float) -> tuple[float, float] | None:
        at = self.disc(lat, lon, km)
        return _place(self.xyz[:, at] @ self.p[at]) if len(at) else None

    def top(self, lat: float, lon: float, km: float) -> tuple[float, float] | None:
        """The cell of greatest p, the first of equal ones."""
        at = self.disc(lat, lon, km)
        best = at[np.argmax(self.p[at])] if len(at) else None
        return None if best is None else (float(self.lat[best]), float(self.lon[best]))

    def existence(self, lat: float, lon: float, s: Settings) -> float:
        """The disc's p over the number of cells of the whole grid."""
        return min(1.0, self.p[self.disc(lat, lon, s.existence_km)].sum() / self.cells * s.existence_scale) if self.cells else 0.0

    def means(self, lat: float, lon: float, km: float) -> np.ndarray:
        """The scalars of the disc, weighted by p; NaN where a cell has none."""
        at = self.disc(lat, lon, km)
        return self.scalars[:, at] @ self.p[at] / self.p[at].sum() if len(at) else np.full(len(self.scalars), np.nan)

    def centred(self, lat: float, lon: float, s: Settings) -> tuple[float, float] | None:
        place: tuple[float, float] | None = (lat, lon)
        if s.mode in ("mode", "mode_then_mean"):
            place = self.top(*place, s.mode_km)
        if place is not None and s.mode in ("mean", "mode_then_mean"):
            place = self.mean(*place, s.mean_km)
        return place

    def candidates(self, s: Settings) -> list[tuple[float, float]]:
        """The greatest cell of each box above the threshold, by falling p."""
        high = np.flatnonzero(self.p > s.box_threshold)
        high = high[np.argsort(-self.p[high], kind="stable")]
        box = np.floor((self.lat[high] + 90) / s.box) * (int(360 / s.box) + 1) + np.floor(self.lon[high] / s.box)
        first = high[np.sort(np.unique(box, return_index=True)[1])]
        return [(float(self.lat[i]), float(self.lon[i])) for i in first if abs(self.lat[i]) <= s.most_lat]


@dataclass
class Centre:
    track: str
    lat: float
    lon: float
    was: tuple[float, float] | None
    existence: float
    scalars: np.ndarray
    merged_into: str | None = None


class Run:
    """A run's centres. A step's rows leave when the next one has told which of them merge."""

    def __init__(self, s: Settings, every: int):
        self.s, self.every, self.step, self.born = s, every, None, 0
        self.active: list[Centre] = []

    def advance(self, step: int, frame: Frame, known: list[Centre]) -> list[tuple[int, Centre]]:
        """Goes on to a step; returns the rows of the step before. Where steps are missing all tracks end."""
        done, s = [(self.step, c) for c in self.active], self.s
        new: list[Centre] = []
        for old in self.active if self.step is not None and step - self.step == self.every else []:
            place = frame.centred(*guess(old.lat, old.lon, old.was, s.momentum), s)
            if place and (p := frame.existence(*place, s)) >= s.least_existence and p > 0:
                new.append(Centre(old.track, *place, (old.lat, old.lon), p, frame.means(*place, s.scalar_km)))
        self._prune(new)
        new += known
        for box in frame.candidates(s):
            if self._clear(new, box):
                place = frame.mean(*box, s.refinement_km)
                if place and (p := frame.existence(*place, s)) >= s.least_existence and p > 0 and self._clear(new, place):
                    new.append(Centre(f"cyclogenesis_{self.born}", *place, None, p, frame.means(*place, s.scalar_km)))
                    self.born += 1
        self.step, self.active = step, new
        return done

    def _clear(self, centres: list[Centre], place: tuple[float, float]) -> bool:
        return not centres or _km(*place, np.array([c.lat for c in centres]), np.array([c.lon for c in centres])).min() >= self.s.apart_km

    def _prune(self, new: list[Centre]) -> None:
        """Of two tracks that came too close the one that moved farther ends in the other, the first such pair first."""
        new.sort(key=lambda c: c.track)
        lats, lons = np.array([c.lat for c in new]), np.array([c.lon for c in new])
        moved = {c.track: _km(*c.was, np.array([c.lat]), np.array([c.lon]))[0] for c in new}
        near = {c.track: {new[j].track for j in np.flatnonzero(_km(c.lat, c.lon, lats, lons) < self.s.prune_km)} - {c.track} for c in new}
        before = {c.track: c for c in self.active}
        while pair := next(((a, b) for a in new for b in new if b.track in near[a.track]), None):
            gone, stays = pair if moved[pair[0].track] >= moved[pair[1].track] else pair[::-1]
            before[gone.track].merged_into = stays.track
            new.remove(gone)


_CELL, _HEADER, _KNOWN = 2, 0, 1


def frame_of(cells: pd.DataFrame, scalars: list[str], n: int) -> Frame:
    """The frame of cells with p > 0, of n cells in all."""
    values = cells[scalars].to_numpy(np.float64).T.reshape(len(scalars), len(cells))
    return Frame(*[cells[c].to_numpy(np.float64) for c in ("lat", "lon", "p")], values, n)


def centres_of(known: pd.DataFrame, scalars: list[str]) -> list[Centre]:
    """Centres that are given, in order of their tracks."""
    return [Centre(r.track, r.lat, r.lon, None if pd.isna(r.was_lat) else (r.was_lat, r.was_lon), 1.0, np.array([getattr(r, c) for c in scalars], float)) for r in known.sort_values("track").itertuples()]


def _folded(batches: Iterator[pd.DataFrame], s: Settings, every: int, scalars: list[str]) -> Iterator[pd.DataFrame]:
    """Walks through rows sorted by run, step and kind; a frame is complete when the next one begins."""
    key, run, parts = None, None, []

    def rows(of, done: list[tuple[int, Centre]]) -> list[tuple]:
        return [(of, c.track, step, c.lat, c.lon, c.existence, c.merged_into, *map(float, c.scalars)) for step, c in done]

    def closed() -> list[tuple]:
        whole = pd.concat(parts) if len(parts) > 1 else parts[0]
        kind = whole["kind"].to_numpy()
        frame = frame_of(whole[kind == _CELL], scalars, int(whole["p"].to_numpy()[kind == _HEADER].sum()))
        return rows(key[0], run.advance(int(key[1]), frame, centres_of(whole[kind == _KNOWN], scalars)))

    names = ["run", "track", "step", "lat", "lon", "existence", "merged_into", *scalars]
    for pdf in batches:
        out, runs, steps = [], pdf["run"].to_numpy(), pdf["step"].to_numpy()
        starts = [0, *(np.flatnonzero((runs[1:] != runs[:-1]) | (steps[1:] != steps[:-1])) + 1).tolist()] if len(pdf) else []
        for a, b in zip(starts, [*starts[1:], len(pdf)], strict=True):
            here = (runs[a], steps[a])
            if key is not None and here != key:
                out += closed()
                parts = []
                if here[0] != key[0]:
                    out += rows(key[0], [(run.step, c) for c in run.active])
                    run = None
            run, key = run or Run(s, every), here
            parts.append(pdf.iloc[a:b])
        if out:
            yield pd.DataFrame(out, columns=names)
    if key is not None:
        last = closed()
        yield pd.DataFrame(last + rows(key[0], [(run.step, c) for c in run.active]), columns=names)


def track(grid: DataFrame, initial: DataFrame | None = None, settings: Settings = Settings(), scalars: list[str] | None = None, every: int = 1) -> DataFrame:
    """run, track, step, lat, lon, existence, merged_into and the scalars of all tracks.

    grid: run, step, cell_lat, cell_lon, p and the scalars' columns; null and NaN p count as 0. initial: run, track, lat,
    lon, perhaps step (the grid's first if absent), was_lat, was_lon (the position before, for the first guess) and scalars;
    its rows are kept as they are, however short their tracks. Tracks that start later are `cyclogenesis_0`,
    `cyclogenesis_1` ... of their run, in order of step and falling peak; those of `least_steps` or fewer steps are dropped.
    A track that is pruned ends at the step before, whose row names the track that it merged into. A scalar is the mean of a
    disc weighted by p, NaN if a cell of it has none. A run's tracks end where a step, `every` after the last, is missing.

    A run lies in one task, which holds the cells of a frame with p > 0 and the centres of a step."""
    values, run_type = list(scalars or []), grid.schema["run"].dataType.simpleString()
    ship(grid.sparkSession)
    missing = lambda names: {c: F.lit(None).cast("double") for c in names}
    whole = grid.select("run", F.col("step").cast("long").alias("step"), F.col("cell_lat").alias("lat"), F.col("cell_lon").alias("lon"), F.coalesce(F.nanvl("p", F.lit(0.0)), F.lit(0.0)).alias("p"), *[F.col(c).cast("double").alias(c) for c in values])
    cells = whole.where("p > 0").withColumn("kind", F.lit(_CELL))
    headers = whole.groupBy("run", "step").agg(F.count(F.lit(1)).cast("double").alias("p")).withColumn("kind", F.lit(_HEADER)).withColumns(missing(["lat", "lon", *values]))
    rows = headers.unionByName(cells).withColumns({"track": F.lit(None).cast("string"), **missing(["was_lat", "was_lon"])})
    if initial is not None:
        first = F.col("step").cast("long") if "step" in initial.columns else F.lit(grid.agg(F.min("step")).first()[0]).cast("long")
        have = lambda c: (F.col(c) if c in initial.columns else F.lit(None)).cast("double").alias(c)
        known = initial.select("run", first.alias("step"), "track", "lat", F.pmod("lon", F.lit(360.0)).alias("lon"), *[have(c) for c in ("was_lat", "was_lon", *values)])
        rows = rows.unionByName(known.withColumns({"kind": F.lit(_KNOWN), "p": F.lit(0.0)}))
    ordered = rows.repartition("run").sortWithinPartitions("run", "step", "kind")
    schema = f"run {run_type}, track string, step long, lat double, lon double, existence double, merged_into string" + "".join(f", `{c}` double" for c in values)
    found = ordered.mapInPandas(lambda batches: _folded(batches, settings, every, values), schema)
    return lasting(found, settings)


def lasting(tracks: DataFrame, settings: Settings) -> DataFrame:
    """tracks without new ones of `least_steps` or fewer steps."""
    length = F.count(F.lit(1)).over(W.partitionBy("run", "track"))
    return tracks.withColumn("_length", length).where(~F.col("track").startswith("cyclogenesis_") | (F.col("_length") > settings.least_steps)).drop("_length")


def consistent(tracks: DataFrame, wind: str = "wind", mode: str = "clip_rmw") -> DataFrame:
    """Tracks whose scalars hold `wind`, rmw and the radii r34_1 ... r64_4, made to obey physics (see `cyclones.enforced`):
    the radii become the arrays r34, r50 and r64, and radii_agree tells whether the checks pass. Other scalars that are not
    radii stay as they are. NaN counts as unknown."""
    names = [f"{name}_{i}" for name in cyclones.THRESHOLDS for i in cyclones.QUADRANTS]
    known = tracks.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in (wind, "rmw", *names)})
    packed = known.withColumns({name: F.array(*[F.col(f"{name}_{i}") for i in cyclones.QUADRANTS]) for name in cyclones.THRESHOLDS}).drop(*names)
    return cyclones.enforced(packed, mode, wind)
