"""Column functions: positions on the sphere, compass tests, time features, rounding to bits."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
YEAR_DAYS = 365.24219


def cartesian(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    a, b = F.radians(lat), F.radians(lon)
    return F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)


def latlon(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Latitude and longitude in [0, 360)."""
    return F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), z)))), F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))


def distance_km(lat0: Column, lon0: Column, lat1: Column, lon1: Column) -> Column:
    """Great-circle distance on the sphere."""
    h = F.pow(F.sin(F.radians(lat1 - lat0) / 2), 2) + F.cos(F.radians(lat0)) * F.cos(F.radians(lat1)) * F.pow(F.sin(F.radians(lon1 - lon0) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


DISTANCE = "2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians({lat1} - {lat0}) / 2), 2) + cos(radians({lat0})) * cos(radians({lat1})) * pow(sin(radians({lon1} - {lon0}) / 2), 2))))"


def is_east(lon0: Column, lon1: Column) -> Column:
    d = lon0 - lon1
    return ((d >= 0) & (d < 180)) | (d < -180)


def in_box(lat: Column, lon: Column, centre_lat: float, centre_lon: float, side_lat: float, side_lon: float) -> Column:
    """Inside a box, across the meridian too; lon in [0, 360)."""
    west, east = (centre_lon - side_lon / 2) % 360, (centre_lon + side_lon / 2) % 360
    across = lon.between(west, east) if west <= east else (lon >= west) | (lon <= east)
    return lat.between(centre_lat - side_lat / 2, centre_lat + side_lat / 2) & (F.lit(True) if side_lon >= 360 else across)


def year_progress(seconds: Column) -> Column:
    years = seconds / (YEAR_DAYS * 86400)
    return years - F.floor(years)


def day_progress(seconds: Column, lon: Column) -> Column:
    return F.pmod((seconds % 86400) / 86400.0 + lon / 360.0, F.lit(1.0))


def fourier(value: Column, period: float, n: int) -> list[Column]:
    """cos, then sin, of n whole frequencies."""
    angle = [value * (2 * math.pi * k / period) for k in range(1, n + 1)]
    return [F.cos(a) for a in angle] + [F.sin(a) for a in angle]


def bit_round(x: Column, keep: int) -> Column:
    """x to `keep` bits after the leading one, ties to even. Values below 2 ** -126 lose bits as single-precision numbers do,
    whose exponent goes no lower; 0, NaN and infinities stay."""
    size = F.greatest(F.abs(x), F.lit(2.0**-126))
    unit = F.pow(F.lit(2.0), F.floor(F.log2(size)) - keep)
    return F.when((x == 0) | F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(F.rint(x / unit) * unit)


def fractional_year(ts: Column) -> Column:
    """The year and the share of it that has gone by."""
    days = F.dayofyear(F.make_date(F.year(ts), F.lit(12), F.lit(31)))
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.year(ts) + (F.dayofyear(ts) - 1 + seconds / 86400) / days


def polar_weight(lat: Column, step: float) -> Column:
    """Area of a cell of `step` degrees on a grid with rows at the poles, not scaled."""
    half = math.radians(step / 2)
    return F.when(F.abs(lat) == 90, math.sin(half / 2) ** 2).otherwise(F.cos(F.radians(lat)) * math.sin(half))


#: Half axis in metres and flattening of the WGS84 ellipsoid.
WGS84 = (6378137.0, 1 / 298.257223563)


def _inverse_km(lat0, lon0, lat1, lon1, axis: float, flat: float, rounds: int = 200):
    """Vincenty's inverse solution, vectorised. Points that are almost opposite may end at the last iterate."""
    u0, u1 = (np.arctan((1 - flat) * np.tan(np.radians(x))) for x in (lat0, lat1))
    apart = np.radians((lon1 - lon0 + 180) % 360 - 180)
    lam = apart
    for _ in range(rounds):
        across = np.cos(u0) * np.sin(u1) - np.sin(u0) * np.cos(u1) * np.cos(lam)
        sin_s = np.hypot(np.cos(u1) * np.sin(lam), across)
        cos_s = np.sin(u0) * np.sin(u1) + np.cos(u0) * np.cos(u1) * np.cos(lam)
        s = np.arctan2(sin_s, cos_s)
        sin_a = np.divide(np.cos(u0) * np.cos(u1) * np.sin(lam), sin_s, out=np.zeros_like(s), where=sin_s != 0)
        cos2_a = 1 - sin_a**2
        mid = np.where(cos2_a > 1e-15, cos_s - 2 * np.sin(u0) * np.sin(u1) / np.maximum(cos2_a, 1e-15), 0.0)
        c = flat / 16 * cos2_a * (4 + flat * (4 - 3 * cos2_a))
        new = apart + (1 - c) * flat * sin_a * (s + c * sin_s * (mid + c * cos_s * (2 * mid**2 - 1)))
        new = np.clip(new, -np.pi, np.pi)
        if np.all(np.abs(new - lam) < 1e-13):
            break
        lam = new
    k = cos2_a * (2 * flat - flat**2) / (1 - flat) ** 2
    a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
    b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    delta = b * sin_s * (mid + b / 4 * (cos_s * (2 * mid**2 - 1) - b / 6 * mid * (4 * sin_s**2 - 3) * (4 * mid**2 - 3)))
    return axis * (1 - flat) * a * (s - delta) / 1000


def ellipsoid_km(lat0: str, lon0: str, lat1: str, lon1: str, ellipsoid: tuple[float, float] = WGS84) -> Column:
    """Geodesic distance on an ellipsoid; the iteration needs Arrow batches. distance_km() is its built-in form on the sphere."""
    @F.pandas_udf("double")
    def distance(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(_inverse_km(*(x.to_numpy(float) for x in (a, b, c, d)), *ellipsoid))

    return distance(*[F.col(c).cast("double") for c in (lat0, lon0, lat1, lon1)])
