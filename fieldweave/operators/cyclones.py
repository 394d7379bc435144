"""Cyclone tracks: detection on grids, motion, radii and their consistency. Unknown radii are null."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geo import cartesian, distance_km, latlon
from ..sources.tables import kept
from .bumps import whole_bumps
from .matching import BLOCK_OFFERS, matched_places
from .neighbours import near_counts
from .spheres import HALF_ROUND_KM, chord, cube, disc_cells, reached_cubes

THRESHOLDS = {"r64": 64.0, "r50": 50.0, "r34": 34.0}
QUADRANTS = (1, 2, 3, 4)


def candidates(field: DataFrame, value: str, box: float, threshold: float) -> DataFrame:
    """The greatest cell of each box of the grid above a threshold; ties to the first cell in (lat, lon) order."""
    best = F.max(F.struct(F.col(value).alias("p"), (-F.col("lat")).alias("a"), (-F.col("lon")).alias("b")))
    boxes = field.groupBy(F.floor((F.col("lat") + 90) / box).cast("long").alias("box_lat"), F.floor(F.col("lon") / box).cast("long").alias("box_lon")).agg(best.alias("m"))
    return boxes.where(F.col("m.p") > threshold).select("box_lat", "box_lon", F.col("m.p").alias("peak"), (-F.col("m.a")).alias("lat"), (-F.col("m.b")).alias("lon"))


def lookback(fixes: DataFrame, now: Column, steps: int) -> DataFrame:
    """Fixes up to `steps` before now of tracks that have a fix at now."""
    alive = fixes.where(F.col("step") == now).select("track_id").distinct()
    return fixes.join(alive, "track_id", "left_semi").where(F.col("step").between(now - steps, now))


def motion(fixes: DataFrame, momentum: float = 1.0) -> DataFrame:
    """Distance from the fix before, and the guess of the next position: the last move carried on along its great circle."""
    track = W.partitionBy("track_id").orderBy("step")
    rows = fixes.withColumns({"lat0": F.lag("lat").over(track), "lon0": F.lag("lon").over(track)}).where(F.col("lat0").isNotNull())
    now, was = cartesian(F.col("lat"), F.col("lon")), cartesian(F.col("lat0"), F.col("lon0"))
    dot = sum((a * b for a, b in zip(now, was, strict=True)), F.lit(0.0))
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
    # Along the great circle by a share of the last move; a track that stood still stays.
    ahead = [F.when(angle < 1e-9, a).otherwise(F.cos(angle * momentum) * a + F.sin(angle * momentum) * (a * F.cos(angle) - b) / F.sin(angle)) for a, b in zip(now, was, strict=True)]
    lat, lon = latlon(*ahead)
    return rows.withColumns({"moved_km": distance_km(F.col("lat0"), F.col("lon0"), F.col("lat"), F.col("lon")), "guess_lat": lat, "guess_lon": lon})


def impute(radii: list[Column], wind: Column, threshold: float) -> tuple[list[Column], Column]:
    """Unknown radii become the mean of the fix's known ones, 0 if none is known, whatever the wind; and a flag: `present`,
    `mean`, and where none is known `zero` at or above the threshold's wind, `missing` below it (an unknown wind is 0)."""
    known = sum((r.isNotNull().cast("int") for r in radii), F.lit(0))
    total = sum((F.coalesce(r, F.lit(0.0)) for r in radii), F.lit(0.0))
    mean = F.when(known > 0, total / known).otherwise(0.0)
    flag = F.when(known == len(radii), "present").when(known > 0, "mean").when(F.coalesce(wind, F.lit(0.0)) >= threshold, "zero").otherwise("missing")
    return [F.coalesce(r, mean) for r in radii], flag


def _cells(rows: DataFrame) -> DataFrame:
    """The quadrants of each threshold as plain columns r64_1 ... r34_4: expressions that code is generated for."""
    return rows.select("*", *[F.col(name).getItem(i - 1).alias(f"{name}_{i}") for name in THRESHOLDS for i in QUADRANTS])


def _arrays(rows: DataFrame) -> DataFrame:
    names = [f"{name}_{i}" for name in THRESHOLDS for i in QUADRANTS]
    return rows.withColumns({name: F.array(*[F.col(f"{name}_{i}") for i in QUADRANTS]) for name in THRESHOLDS}).drop(*names)


def _top(name: str) -> Column:
    return F.greatest(*[F.col(f"{name}_{i}") for i in QUADRANTS])  # nulls are skipped


def _rising(rows: DataFrame) -> DataFrame:
    """Radii of weaker winds raised to those of stronger ones in the same quadrant; an unknown radius stays unknown."""
    up = lambda a, *bs: F.when(a.isNotNull(), F.greatest(a, *bs))
    rows = rows.withColumns({f"r50_{i}": up(F.col(f"r50_{i}"), F.col(f"r64_{i}")) for i in QUADRANTS})
    return rows.withColumns({f"r34_{i}": up(F.col(f"r34_{i}"), F.col(f"r50_{i}"), F.col(f"r64_{i}")) for i in QUADRANTS})


def _clipped(rows: DataFrame, wind: str) -> DataFrame:
    """No radius below 0, and none above 0 for a wind that is not reached; an unknown wind clips nothing."""
    clip = lambda c, t: F.when(c.isNotNull(), F.when(F.col(wind) < t, 0.0).otherwise(F.greatest(c, F.lit(0.0))))
    return rows.withColumns({f"{name}_{i}": clip(F.col(f"{name}_{i}"), t) for name, t in THRESHOLDS.items() for i in QUADRANTS})


def _clipped_rmw(rows: DataFrame, wind: str) -> DataFrame:
    """The radius of maximum wind not above the largest radius of any threshold that the wind reaches; unknown stays unknown."""
    tops = [F.when(F.col(wind) >= t, _top(name)) for name, t in THRESHOLDS.items()]
    return rows.withColumn("rmw", F.when(F.col("rmw").isNotNull(), F.least("rmw", *tops)))


def consistent(storms: DataFrame, wind: str = "wind_a") -> DataFrame:
    """Radii that obey physics: none negative, 0 below their threshold's wind, not smaller than those of a stronger wind in
    the same quadrant; and a radius of maximum wind not above the largest radius of any threshold that the wind reaches."""
    return _arrays(_clipped_rmw(_rising(_clipped(_cells(storms), wind)), wind))


def _raised(rows: DataFrame, wind: str) -> DataFrame:
    """Of each threshold that the wind reaches the largest radius, the first of equal ones, raised to that of maximum wind."""
    for name, threshold in THRESHOLDS.items():
        top, new = _top(name), {}
        for i in QUADRANTS:
            own = F.col(f"{name}_{i}")
            first = own.eqNullSafe(top)
            for j in range(1, i):
                first = first & ~F.col(f"{name}_{j}").eqNullSafe(top)
            new[f"{name}_{i}"] = F.when((F.col(wind) >= threshold) & top.isNotNull() & first, F.greatest(own, F.col("rmw"))).otherwise(own)
        rows = rows.withColumns(new)
    return rows


def raised_radii(storms: DataFrame, wind: str = "wind_a") -> DataFrame:
    """The other way to agree with the radius of maximum wind: of each threshold that the wind reaches the largest radius (the
    first of equal ones) is raised to it, then radii of weaker winds are raised to those of stronger ones."""
    return _arrays(_rising(_raised(_cells(storms), wind)))


def enforced(storms: DataFrame, mode: str = "clip_rmw", wind: str = "wind_a") -> DataFrame:
    """All rules at once, with `radii_agree`, whether the rows now pass the checks: negative winds and radii become 0, radii of
    winds that are not reached 0, radii fall with rising wind; then either the radius of maximum wind is clipped
    (`clip_rmw`) or the largest radii are raised to it (`raise_radii`), after which they are made to rise outward again."""
    if mode not in ("clip_rmw", "raise_radii"):
        raise ValueError(f"mode is clip_rmw or raise_radii, not {mode}")
    floor = lambda c: F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.lit(0.0)))
    rows = _cells(storms.withColumns({wind: floor(wind), "rmw": floor("rmw")}))
    rows = _rising(_clipped(rows, wind))
    rows = _clipped_rmw(rows, wind) if mode == "clip_rmw" else _rising(_raised(rows, wind))
    return _arrays(rows.withColumn("radii_agree", radii_agree(wind)))


def radii_agree(wind: str = "wind_a") -> Column:
    """The checks, on the plain columns: in each quadrant radii do not fall as winds weaken, and the radius of maximum wind
    is not above the largest radius of any threshold that the wind reaches. What is unknown is not checked."""
    ok = F.lit(True)
    for i in QUADRANTS:
        for strong, weak in (("r64", "r50"), ("r50", "r34"), ("r64", "r34")):
            ok = ok & F.coalesce(F.col(f"{strong}_{i}") <= F.col(f"{weak}_{i}"), F.lit(True))
    for name, threshold in THRESHOLDS.items():
        ok = ok & F.coalesce((F.col(wind) < threshold) | (F.col("rmw") <= _top(name)), F.lit(True))
    return ok


def checked(storms: DataFrame, wind: str = "wind_a") -> DataFrame:
    """storms with `radii_agree`, as they are."""
    return _arrays(_cells(storms).withColumn("radii_agree", radii_agree(wind)))


def disc_raster(points: DataFrame, value: str, radius_km: float, cell: float) -> DataFrame:
    """On a grid of `cell` degrees: the greatest value of the points whose disc holds the cell."""
    near = disc_cells(points, F.lit(radius_km), cell)
    return near.groupBy("cell_lat", "cell_lon").agg(F.max(value).alias("greatest"))


def gaussian_raster(points: DataFrame, radius_km: float, cell: float, value: Column | None = None, keys: tuple[str, ...] = (), normalized: bool = False, most_error: float = 0.0) -> DataFrame:
    """By keys and cell: the sum over points of value * exp(-d * d / (2 * radius * radius)), each point's bump scaled to sum 1
    over the grid if `normalized`.

    With most_error 0 every point reaches every cell (see `bumps`). Above 0 a point of weight w reaches as far as its bump, times w, is
    above most_error: each cell then lacks that much a point, at most. Points at one place are added up before they are
    spread, cells are made from the point and not joined, and partial sums are combined before they are shuffled."""
    places = points.groupBy(*keys, "lat", "lon").agg(F.sum(F.lit(1.0) if value is None else value).alias("_weight"))
    if most_error <= 0:
        return whole_bumps(places, radius_km, cell, list(keys), normalized)
    reach = F.least(F.lit(HALF_ROUND_KM), radius_km * F.sqrt(2 * F.greatest(F.lit(0.0), F.ln(F.abs("_weight") / most_error))))
    bumps = lambda rows: disc_cells(rows, reach, cell).withColumn("_g", F.exp(-0.5 * (F.col("d") / radius_km) ** 2))
    if normalized:
        # Totals are one row a place, so the cells, which are made twice, never move before they are summed.
        names = [*keys, "lat", "lon"]
        totals = bumps(places).groupBy(*names).agg(F.sum("_g").alias("_total")).withColumnsRenamed({c: f"_{c}" for c in names})
        places = places.join(totals, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names])).drop(*[f"_{c}" for c in names])
    near = bumps(places)
    if normalized:
        near = near.withColumn("_g", F.col("_g") / F.col("_total"))
    return near.groupBy(*keys, "cell_lat", "cell_lon").agg(F.sum(F.col("_weight") * F.col("_g")).alias("gaussian"))


def nearby(fixes: DataFrame, radius_km: float) -> DataFrame:
    """For each fix: how many other tracks' fixes of the same step lie within the radius, and whether one has more wind. A track
    has one fix a step. Pairs are counted where they lie close (see `neighbours`), and no row is made for one."""
    tracked = fixes.where("track_id IS NOT NULL AND step IS NOT NULL")
    met = fixes.join(near_counts(tracked, ["step"], "wind", radius_km), ["step", "lat", "lon"], "left")
    others = F.col("known") - F.col("wind").isNotNull().cast("long")
    tracked_one = F.col("track_id").isNotNull()
    return met.select("track_id", "step", F.when(tracked_one & F.col("wind").isNotNull() & (others > 0), F.col("top") > F.col("wind")).alias("outranked"), F.coalesce(F.when(tracked_one, F.col("near") - 1), F.lit(0)).alias("nearby"))


def speeds_fall(pairs: Column) -> Column:
    """Whether speeds never rise outward: `pairs` are structs (radius, speed), those without a radius left out."""
    known = F.sort_array(F.filter(pairs, lambda p: p["radius"].isNotNull() & p["speed"].isNotNull()))
    n = F.size(known)
    steps = F.zip_with(F.slice(known, 1, F.greatest(n - 1, F.lit(0))), F.slice(known, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: (a["radius"] == b["radius"]) | (b["speed"] <= a["speed"]))
    return F.forall(steps, lambda ok: ok)


def calibrated_wind(storms: DataFrame, base: str, others: list[str], when: Column | None = None, skip_without_overlap: bool = True, on_base: bool = False) -> DataFrame:
    """`merged`: the mean of the base agency's wind and of the others', each put through a line and cut at 0.

    A line is fitted by least squares over the storms that both agencies know, those for which `when` holds: of the base on
    the agency, or (on_base) of the agency on the base, as the published processing does although it then applies the line
    to the agency's winds. An agency without common storms passes as it is, or is an error. The fits come as one row."""
    rows = storms if when is None else storms.where(when)
    pair = (lambda o: (F.col(o), F.col(base))) if on_base else (lambda o: (F.col(base), F.col(o)))
    both = lambda o: F.count(F.when(F.col(base).isNotNull() & F.col(o).isNotNull(), 1))
    fits = rows.agg(*[c.alias(f"_{n}_{o}") for o in others for n, c in (("a", F.regr_slope(*pair(o))), ("b", F.regr_intercept(*pair(o))), ("n", both(o)))])
    if not skip_without_overlap:
        fits = fits.select("*").withColumns({f"_n_{o}": F.when(F.col(f"_n_{o}") == 0, F.raise_error(F.lit(f"no common storms of {base} and {o}")).cast("long")).otherwise(F.col(f"_n_{o}")) for o in others})
    line = lambda o: F.when(F.col(f"_n_{o}") == 0, F.col(o)).otherwise(F.col(f"_a_{o}") * F.col(o) + F.col(f"_b_{o}"))
    known = [F.col(base), *[F.when(F.col(o).isNotNull() & line(o).isNotNull(), F.greatest(F.lit(0.0), line(o))) for o in others]]
    number = sum((k.isNotNull().cast("int") for k in known), F.lit(0))
    mean = F.when(number > 0, sum((F.coalesce(k, F.lit(0.0)) for k in known), F.lit(0.0)) / number)
    return storms.join(F.broadcast(fits)).withColumn("merged", mean).drop(*[f"_{n}_{o}" for o in others for n in "abn"])


def densities(points: DataFrame, scale_km: float, cell: float, most_error: float = 0.0) -> DataFrame:
    """Per cell of the whole grid the sum of the points' Gaussian densities, each of which sums to 1 over the grid."""
    return gaussian_raster(points, scale_km, cell, normalized=True, most_error=most_error).withColumnRenamed("gaussian", "density")


def disc_values(points: DataFrame, value: str, radius_km: float, cell: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per cell that a disc holds: the greatest value, 0 at least; a disc whose value is NaN makes its cells NaN."""
    near = disc_cells(points, F.lit(radius_km), cell)
    return near.groupBy(*keys, "cell_lat", "cell_lon").agg(F.greatest(F.max(value), F.lit(0.0)).alias("value"), F.bool_or(F.isnan(value)).alias("has_nan"))


def is_core(name: Column, core: list[str]) -> Column:
    """Whether a name occurs inside one of the core names."""
    return F.exists(F.array(*map(F.lit, core)), lambda c: F.contains(c, name))


def nan_tracks(tracks: DataFrame, columns: list[str], lead: str | None = None) -> DataFrame:
    """How many rows of the tracks have NaN or null in any of the columns; rows with `lead` 0 do not count if it is given."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull() | F.isnan(c)
    rows = tracks if lead is None else tracks.where(F.col(lead) != 0)
    return rows.agg(F.count(F.when(bad, 1)).alias("incomplete"), F.count(F.lit(1)).alias("rows"))


def compared(truth: DataFrame, found: DataFrame, most_km: float, scalars: list[str], tolerance: float) -> DataFrame:
    """By step: rows of both sets of tracks, truth's rows that have a row within most_km, and those among them of which one
    such row agrees in all scalars within the tolerance. Rows meet by step and by cubes of space: places, whatever the rows
    at them, to be near, and rows, by spans of the first scalar too, to agree."""
    side, width = max(4 * chord(most_km), 1e-3), 4 * tolerance or 1.0
    rows = truth.groupBy("step", "lat", "lon", *scalars).agg(F.count(F.lit(1)).alias("_n"))
    others = found.select("step", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), *[F.col(c).alias(f"_{c}") for c in scalars]).distinct()
    agree = F.lit(True)
    for c in scalars:
        agree = agree & F.coalesce(F.abs(F.col(c) - F.col(f"_{c}")) <= tolerance, F.col(c).isNull() & F.col(f"_{c}").isNull())

    def met(here: DataFrame, there: DataFrame, *more: Column) -> DataFrame:
        """Rows of here, by step, that meet one of there."""
        sent, names = reached_cubes(here, side, most_km), ["_cx", "_cy", "_cz"]
        there = there.withColumns(cube(F.col("_lat"), F.col("_lon"), side)).withColumnsRenamed({n: f"_{n}" for n in ["step", *names]})
        on = [F.col(n) == F.col(f"_{n}") for n in ["step", *names]]
        near = distance_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")) <= most_km
        return sent.join(there, reduce(and_, [*on, near, *more]), "left_semi").select(*[c for c in here.columns if c != "_span"]).distinct().groupBy("step")

    if scalars:
        first = F.col(scalars[0]).cast("double")
        pad = tolerance * (1 + 1e-9) + F.abs(first) * 5e-16  # what rounding may add
        spans = F.sequence(*[F.floor((first + d) / width) for d in (-pad, pad)])
        with_span = rows.withColumn("_span", F.explode(F.when(first.isNull(), F.array(F.lit(None).cast("long"))).when(F.abs(first) < float("inf"), spans)))
        with_other = others.withColumn("__span", F.floor(F.col(f"_{scalars[0]}").cast("double") / width))
        agreeing = met(with_span, with_other, F.col("_span").eqNullSafe(F.col("__span")), agree)
    else:
        agreeing = met(rows, others)
    places = truth.groupBy("step", "lat", "lon").agg(F.count(F.lit(1)).alias("_n"))
    near = met(places, others.select("step", "_lat", "_lon").distinct()).agg(F.sum("_n").alias("near"))
    sizes = truth.groupBy("step").agg(F.count(F.lit(1)).alias("truth_rows")).join(found.groupBy("step").agg(F.count(F.lit(1)).alias("found_rows")), "step", "full")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return sizes.join(near, "step", "left").join(agreeing.agg(F.sum("_n").alias("agreeing")), "step", "left").select("step", *[zero(c) for c in ("truth_rows", "found_rows", "near", "agreeing")])


def near_pairs(truth: DataFrame, found: DataFrame, keys: list[str], most_km: float) -> DataFrame:
    """keys, track_id, match_id, km of the fixes of two sets of tracks with equal keys that lie nearer than most_km. Fixes meet
    by keys and cubes of space."""
    side = max(2 * chord(most_km), 1e-3)
    here = reached_cubes(truth.select(*keys, "track_id", "lat", "lon"), side, most_km)
    there = found.select(*keys, F.col("track_id").alias("match_id"), "lat", "lon")
    there = there.withColumns(cube(F.col("lat"), F.col("lon"), side)).withColumnsRenamed({"lat": "_lat", "lon": "_lon"})
    met = here.join(there, [*keys, "_cx", "_cy", "_cz"]).withColumn("km", distance_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")))
    return met.where(F.col("km") < most_km).select(*keys, "track_id", "match_id", "km")


def matched(truth: DataFrame, found: DataFrame, most_km: float = 500.0, block_offers: int = BLOCK_OFFERS) -> DataFrame:
    """One-to-one pairs of the fixes of two sets of tracks at each step, nearer than most_km: step, track_id, match_id, km. A
    fix may stay alone at the cost of most_km. A track has one fix a step.

    Fixes at one place are paired first, in the order of their tracks: no sum of distances is less without that, as a way
    round by one place is no shorter than the straight one. Of the others the sum of the costs, in whole metres, is the least.
    They are settled by auction (see `matching`), and only pairs that its prices ask for are made. A task holds the fixes of a
    step of up to block_offers; larger steps are settled in cubes and in blocks of block_offers offers."""
    there = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    fix = lambda rows, side: rows.where(F.col("step").isNotNull() & F.col("track_id").isNotNull() & there("lat") & there("lon")).select("step", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.col("track_id").alias("id"), F.lit(side).alias("_side"))
    place = ["step", "lat", "lon"]
    numbered = fix(truth, 0).unionByName(fix(found, 1)).withColumn("_k", F.row_number().over(W.partitionBy(*place, "_side").orderBy("id")))
    own = lambda side: F.max(F.when(F.col("_side") == side, F.col("id")))
    met = kept(numbered.groupBy(*place, "_k").agg(own(0).alias("track_id"), own(1).alias("match_id")))
    left, right = (met.where(F.col(other).isNull()).select(F.col("step").alias("group"), F.col(i).alias("id"), "lat", "lon") for i, other in (("track_id", "match_id"), ("match_id", "track_id")))
    won = matched_places(left, right, most_km, block_offers).select(F.col("group").alias("step"), F.col("left").alias("track_id"), F.col("right").alias("match_id"))
    at = lambda rows, i, mark: rows.select(F.col("group").alias("step"), F.col("id").alias(i), F.col("lat").alias(f"{mark}lat"), F.col("lon").alias(f"{mark}lon"))
    near = won.join(at(left, "track_id", ""), ["step", "track_id"]).join(at(right, "match_id", "_"), ["step", "match_id"])
    same = met.where("track_id IS NOT NULL AND match_id IS NOT NULL").select("step", "track_id", "match_id", F.lit(0.0).alias("km"))
    return same.unionByName(near.select("step", "track_id", "match_id", distance_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")).alias("km")))
