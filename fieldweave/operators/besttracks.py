"""Best tracks from raw records: nested storms to clean rows, lists of initial times, names of gridded variables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType

# Nautical miles of a km as the published processing has them, hours of a fix, and names of quadrants in order.
NAUTICAL_PER_KM = 0.539957
HOURS = (0, 6, 12, 18)
QUADRANT_NAMES = ("ne", "se", "sw", "nw")
THRESHOLDS = (34, 50, 64)

# What a variable of each kind becomes on a grid.
SUFFIXES = {
    "existence": ("exists_sparse", "exists_disc", "exists_gaussian_unit_mode", "exists_gaussian_probability"),
    "scalar": ("sparse", "disc"),
    "category": ("sparse", "disc"),
    "shape": ("shape",),
}


def text(value: Column, of: DataType) -> Column:
    """A value as trimmed text; bytes are UTF-8; blank is null."""
    words = F.trim(F.decode(value, "UTF-8") if isinstance(of, BinaryType) else value.cast("string"))
    return F.when(words != "", words)


def number(value: Column, of: DataType) -> Column:
    """A value as a double: text and bytes are read, what is blank, no number or NaN is null."""
    found = text(value, of).try_cast("double") if isinstance(of, (BinaryType, StringType)) else value.cast("double")
    return F.when(~F.isnan(found), found)


def converted(storms: DataFrame, years: int | list[int], hours: tuple[int, ...] = HOURS) -> DataFrame:
    """A row a fix of nested storms: sid, and `fixes`, an array of structs (time, lat, lon, pressure, wind, rmw, r34, r50, r64).

    Numbers may be text or bytes; lengths are nautical miles and become km, radii a column a quadrant (r34_ne_km ...; null
    where an array is too short). Fixes without time or place, of other years, or whose hour is none of `hours`, are left
    out; so storms without a fix in the years vanish. Each storm is opened where it lies: nothing is shuffled."""
    inside = storms.schema["fixes"].dataType.elementType
    wanted = F.filter("fixes", lambda f: F.year(f["time"]).isin(years if isinstance(years, list) else [years]) & F.hour(f["time"]).isin(list(hours)))
    rows = storms.select(text(F.col("sid"), storms.schema["sid"].dataType).alias("track_id"), F.explode(wanted).alias("f"))
    plain = {c: number(F.col(f"f.{c}"), inside[c].dataType) for c in ("lat", "lon", "pressure", "wind", "rmw")}
    radii = []
    for t in THRESHOLDS:
        of = inside[f"r{t}"].dataType
        assert isinstance(of, ArrayType)
        radii += [(number(F.get(f"f.r{t}", i), of.elementType) / NAUTICAL_PER_KM).alias(f"r{t}_{q}_km") for i, q in enumerate(QUADRANT_NAMES)]
    lon = F.pmod(plain["lon"], F.lit(360.0)).alias("lon")
    out = rows.select("track_id", plain["lat"].alias("lat"), lon, F.col("f.time").alias("time"), plain["pressure"].alias("pressure"), plain["wind"].alias("wind"), (plain["rmw"] / NAUTICAL_PER_KM).alias("rmw_km"), *radii)
    return out.where("lat is not null and lon is not null")


def init_times(lines: DataFrame, line: str = "value") -> DataFrame:
    """The distinct times (`init`) of a file of lines: what follows a # is a comment, blank lines count for nothing, and a
    line that is no time fails when it is read."""
    said = F.trim(F.element_at(F.split(line, "#", 2), 1))
    at = said.try_cast("timestamp_ntz")
    told = F.raise_error(F.concat(F.lit("no time: "), said)).cast("timestamp_ntz")
    return lines.where(said != "").select(F.coalesce(at, told).alias("init")).distinct()


def gridded_names(variables: DataFrame) -> DataFrame:
    """The distinct names that variables (kind, variable) have on a grid. A kind is `existence` (a variable is an agency, null
    for all of them together), `scalar`, `category` or `shape`; another kind has no name."""
    suffixes = F.coalesce(*[F.when(F.col("kind") == k, F.array(*map(F.lit, s))) for k, s in SUFFIXES.items()])
    return variables.select("variable", F.explode(suffixes).alias("suffix")).select(F.concat_ws("_", F.lit("cyclone"), "variable", "suffix").alias("name")).distinct()
