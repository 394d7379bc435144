"""Random numbers that belong to keys: a row draws the same numbers whatever task or partition holds it, and again after a
lost executor. White noise is column arithmetic; noise with a power spectrum on the sphere is summed in Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of a digest that make a uniform number.
DIGITS = 12


def key_of(seed: int, *parts: Column) -> Column:
    """The key of a draw: a base seed and, say, the initial time, the member and the step."""
    return F.concat_ws("/", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def uniform(key: Column, name: str) -> Column:
    """A number in (0, 1) that depends on the key and a name only."""
    digits = F.substring(F.md5(F.concat_ws("/", key, F.lit(name)).cast("binary")), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DIGITS)


def normal(key: Column) -> Column:
    """A draw from the standard normal distribution, by the Box-Muller transform."""
    return F.sqrt(-2 * F.log(uniform(key, "radius"))) * F.cos(2 * np.pi * uniform(key, "angle"))


def harmonics(lat: np.ndarray, lon: np.ndarray, degrees: int) -> np.ndarray:
    """[points, degrees ** 2] real spherical harmonics below `degrees`, at degree * degree + degree + order; mean square 1.

    Fully normalised Legendre functions: along the diagonal from one order to the next, then upwards in degree."""
    s, c = np.sin(np.radians(lat)), np.cos(np.radians(lat))
    out = np.empty((len(lat), degrees * degrees))
    diagonal = np.ones(len(lat))
    for m in range(degrees):
        if m:
            diagonal = diagonal * c * np.sqrt((2 * m + 1) / (2 * m))
        below, here = np.zeros(len(lat)), diagonal
        around = (np.cos(m * np.radians(lon)) * np.sqrt(2), np.sin(m * np.radians(lon)) * np.sqrt(2)) if m else (np.ones(len(lat)),)
        for n in range(m, degrees):
            if n > m:
                a = np.sqrt((4 * n * n - 1) / (n * n - m * m))
                b = np.sqrt(((n - 1) ** 2 - m * m) / (4 * (n - 1) ** 2 - 1)) if n > 1 else 0.0
                below, here = here, a * (s * here - b * below)
            for sign, wave in zip((1, -1), around, strict=False):
                out[:, n * n + n + sign * m] = here * wave
    return out


def isotropic(lat: Column, lon: Column, key: Column, power: list[float]) -> Column:
    """Gaussian noise at points, of a field for each key whose expected power at degree n is power[n]; its variance at a
    point is their sum. Null positions or keys give null."""
    degrees = len(power)
    scale = np.repeat(np.sqrt(np.array(power) / (2 * np.arange(degrees) + 1)), 2 * np.arange(degrees) + 1)

    @F.pandas_udf("double")
    def summed(lats: pd.Series, lons: pd.Series, seeds: pd.Series) -> pd.Series:
        names, at = np.unique(seeds.fillna(0).to_numpy(np.int64), return_inverse=True)
        weights = np.stack([np.random.default_rng(int(n) & (2**64 - 1)).normal(size=degrees * degrees) * scale for n in names]) if len(names) else np.zeros((0, degrees * degrees))
        out = np.empty(len(lats))
        for a in range(0, len(out), 4096):
            some = slice(a, a + 4096)
            out[some] = np.einsum("pk,pk->p", harmonics(lats[some].to_numpy(float), lons[some].to_numpy(float), degrees), weights[at[some]])
        return pd.Series(out)

    return F.when(lat.isNotNull() & lon.isNotNull() & key.isNotNull(), summed(lat.cast("double"), lon.cast("double"), F.xxhash64(key)))


def _legendre(lat: np.ndarray, degrees: int) -> np.ndarray:
    """[latitudes, orders, degrees]: the part of `harmonics` that depends on latitude."""
    at_zero = harmonics(lat, np.zeros(len(lat)), degrees)
    out = np.zeros((len(lat), degrees, degrees))
    for m in range(degrees):
        for n in range(m, degrees):
            out[:, m, n] = at_zero[:, n * n + n + m]
    return out  # orders above 0 hold the square root of 2 that their waves have


def isotropic_grid(keys: DataFrame, key: str, lats: list[float], lons: list[float], power: list[float]) -> DataFrame:
    """(the columns of keys, lat, lon, noise): the field of each key, as `isotropic`, at all points of a grid.

    Summed apart: a row of latitudes meets the coefficients of each order once (Legendre sums), then the waves along it; a
    point costs as many terms as there are degrees, not their square. A row of the grid is made in one task."""
    degrees, names = len(power), keys.columns
    scale = np.repeat(np.sqrt(np.array(power) / (2 * np.arange(degrees) + 1)), 2 * np.arange(degrees) + 1)
    types = {f.name: f.dataType.simpleString() for f in keys.schema}
    around = np.radians(np.array(lons, float))
    orders = np.arange(degrees)
    cosines, sines = np.cos(orders[:, None] * around), np.sin(orders[:, None] * around)

    def rows(batches):
        for pdf in batches:
            legendre = _legendre(pdf["_lat"].to_numpy(float), degrees)
            known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            parts = []
            for i, seed in enumerate(pdf["_seed"].tolist()):
                if seed not in known:
                    drawn = np.random.default_rng(seed & (2**64 - 1)).normal(size=degrees * degrees) * scale
                    even, odd = np.zeros((degrees, degrees)), np.zeros((degrees, degrees))
                    for m in range(degrees):
                        n = np.arange(m, degrees)
                        even[m, n], odd[m, n] = drawn[n * n + n + m], drawn[n * n + n - m] * (m > 0)
                    known = {seed: (even, odd)}  # rows come key by key
                even, odd = known[seed]
                parts.append((legendre[i] * even).sum(axis=1) @ cosines + (legendre[i] * odd).sum(axis=1) @ sines)
            out = pdf[names].loc[pdf.index.repeat(len(around))].reset_index(drop=True)
            yield out.assign(lat=pdf["_lat"].to_numpy().repeat(len(around)), lon=np.tile(np.array(lons, float), len(pdf)), noise=np.concatenate(parts) if parts else [])

    seeds = keys.where(F.col(key).isNotNull()).withColumn("_seed", F.xxhash64(F.col(key)))
    spread = seeds.withColumn("_lat", F.explode(F.array(*[F.lit(float(v)) for v in lats])))
    return spread.mapInPandas(rows, ", ".join(f"`{c}` {types[c]}" for c in names) + ", lat double, lon double, noise double")
