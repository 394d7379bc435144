"""Solar radiation at the top of the atmosphere, as column functions."""

from __future__ import annotations

import math

import numpy
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The series of the sun's apparent motion, by years of 365.25 days since noon of 1 January 2000.
J2000_JULIAN, UNIX_JULIAN, JULIAN_YEAR = 2451545.0, 2440587.5, 365.25
ORBIT_ANGLE, ANOMALY, MEAN_LONGITUDE = (1.7535, 6.283076), (6.240041, 6.283020), (4.8951, 6.283076)
TRUE_LONGITUDE = (4.8952, 6.283320, -0.0075, -0.0326, -0.0003, 0.0002)
OBLIQUITY = 0.409093
TIME_EQUATION = (591.8, -459.4, 39.5, -12.7, -4.8)
DISTANCE_AU = (1.0001, -0.0163, 0.0037)


def j2000_days(micros: Column) -> Column:
    return micros / 8.64e10 + (UNIX_JULIAN - J2000_JULIAN)


def _flux(day, lat, lon, tsi, np):
    """W/m2 at moments in days since J2000; lat and lon in radians. Nothing falls on the night side."""
    years = day / JULIAN_YEAR
    orbit, anomaly, mean = (a + b * years for a, b in (ORBIT_ANGLE, ANOMALY, MEAN_LONGITUDE))
    sin_orbit, cos_orbit, sin_anomaly = np.sin(orbit), np.cos(orbit), np.sin(anomaly)
    a, b, *c = TRUE_LONGITUDE
    declination = math.sin(OBLIQUITY) * np.sin(a + b * years + c[0] * sin_orbit + c[1] * cos_orbit + c[2] * np.sin(2 * orbit) + c[3] * np.cos(2 * orbit))
    terms = (np.sin(2 * mean), sin_anomaly, sin_anomaly * np.cos(2 * mean), np.sin(4 * mean), np.sin(2 * anomaly))
    seconds = sum(t * e for t, e in zip(terms, TIME_EQUATION, strict=True))
    distance = DISTANCE_AU[0] + DISTANCE_AU[1] * sin_orbit + DISTANCE_AU[2] * cos_orbit
    hour_angle = (day - np.floor(day) + seconds / 86400) * (2 * math.pi) + lon
    altitude = np.cos(lat) * np.sqrt(1 - declination * declination) * np.cos(hour_angle) + np.sin(lat) * declination
    night = altitude * 0
    return tsi / (distance * distance) * (np.maximum(altitude, night) if np is numpy else np.greatest(altitude, night))


def flux(day: Column, lat: Column, lon: Column, tsi: Column) -> Column:
    """The flux at one moment, of built-in functions."""
    return _flux(day, lat, lon, tsi, F)


def integrated(day: Column, lat: Column, lon: Column, tsi: Column, hours: float = 1.0, bins: int = 360) -> Column:
    """J/m2 over the `hours` that end at `day`, by the trapezoidal rule; lat and lon in degrees. A row stays one row.

    In Arrow batches: as a higher-order function over the bins, which no code is generated for, it took 40 times as long."""
    offsets = numpy.arange(-bins, 1) * (hours / 24 / bins)
    weights = numpy.where(numpy.isin(offsets, offsets[[0, -1]]), 0.5, 1.0) * (hours * 3600 / bins)

    @F.pandas_udf("double")
    def joules(day: pd.Series, lat: pd.Series, lon: pd.Series, tsi: pd.Series) -> pd.Series:
        out = numpy.empty(len(day))
        for at in range(0, len(day), 1000):
            d, a, b, t = (x.iloc[at : at + 1000].to_numpy(float)[:, None] for x in (day, lat, lon, tsi))
            out[at : at + 1000] = _flux(d + offsets, numpy.radians(a), numpy.radians(b), t, numpy) @ weights
        return pd.Series(out)

    return joules(*[c.cast("double") for c in (day, lat, lon, tsi)])
