"""Queries that grid best-track fixes: existence, scalars, categories and quadrants of every step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import gridding
from ..sources.views import FIXES, fixes
from .registry import query

CELL = 10.0
GRID = "grid AS (SELECT (b * 10 - 90)::DOUBLE AS cell_lat, (c * 10)::DOUBLE AS cell_lon FROM range(0, 19) t(b), range(0, 36) u(c))"
_D = geo.DISTANCE.format(lat0="cell_lat", lon0="cell_lon", lat1="lat", lon1="lon")

#: Fixes with a pressure that some lack, a category, and radii of which one or all may be unknown.
RECORDS = f"""{FIXES}, r AS (SELECT *, CASE WHEN track_id % 7 = 0 THEN 'NaN'::DOUBLE ELSE 1010 - wind / 10 END AS pressure, floor(wind / 60) - 5 AS category,
CASE WHEN step % 5 = 0 THEN [NULL, NULL, NULL, NULL]::DOUBLE[] ELSE [wind, wind * 0.75, wind * 0.5, CASE WHEN step % 3 = 0 THEN NULL ELSE wind * 0.9 END] END AS radii FROM fixes)"""


def records(spark, sf_dir) -> DataFrame:
    w = F.col("wind")
    none = F.array(*[F.lit(None).cast("double")] * 4)
    radii = F.when(F.col("step") % 5 == 0, none).otherwise(F.array(w, w * 0.75, w * 0.5, F.when(F.col("step") % 3 != 0, w * 0.9)))
    pressure = F.when(F.col("track_id") % 7 == 0, F.lit(float("nan"))).otherwise(1010 - w / 10)
    return fixes(spark, sf_dir).withColumns({"pressure": pressure, "category": F.floor(w / 60) - 5, "radii": radii})


def _out(rows):
    return rows.select("step", "variable", "cell_lat", (F.col("cell_lon") + 0.0).alias("cell_lon"), (F.round("value", 6) + 0.0).alias("value"))


@query(f"""WITH {FIXES}, {GRID}, near AS (SELECT track_id, step, cell_lat, cell_lon, {_D} AS d FROM grid, fixes)
SELECT step, 'exists_gaussian_unit_mode' AS variable, cell_lat, cell_lon, round(sum(exp(-0.5 * pow(d / 1000, 2))), 6) + 0.0 AS value FROM near GROUP BY 1, 3, 4""")
def gridded_existence(spark, sf_dir):
    return _out(gridding.existence(fixes(spark, sf_dir), ["step"], 1000.0, CELL))


@query(f"""WITH {FIXES}, {GRID}, n AS (SELECT DISTINCT step, (round((lat + 90) / 10) * 10 - 90) AS cell_lat, (round(lon / 10) * 10) % 360 AS cell_lon FROM fixes),
g AS (SELECT track_id, step, cell_lat, cell_lon, exp(-0.5 * pow({_D} / 1000, 2)) AS g FROM grid, fixes), s AS (SELECT *, sum(g) OVER (PARTITION BY track_id, step) AS total FROM g),
sub AS (SELECT cell_lat AS c_lat, cell_lon AS c_lon, greatest(-90.0, least(90.0, cell_lat + ((i + 0.5) / 4 - 0.5) * 10)) AS cell_lat, (cell_lon + ((j + 0.5) / 4 - 0.5) * 10 + 360) % 360 AS cell_lon FROM grid, range(0, 4) v(i), range(0, 4) w(j)),
near AS (SELECT step, c_lat, c_lon, {_D} AS d FROM sub JOIN fixes ON abs(cell_lat - lat) < 10)
SELECT step, 'exists_sparse' AS variable, cell_lat, cell_lon, 1.0 AS value FROM n
UNION ALL SELECT step, 'exists_gaussian_probability', cell_lat, cell_lon, round(sum(g / total), 6) + 0.0 FROM s GROUP BY 1, 3, 4
UNION ALL SELECT step, 'exists_disc', c_lat, c_lon, round(count(*) / 16, 6) FROM near WHERE d < 1000 GROUP BY 1, 3, 4""")
def gridded_existence_more(spark, sf_dir):
    """The existence fields beyond the core."""
    found = gridding.existence(fixes(spark, sf_dir), ["step"], 1000.0, CELL, core=False)
    return _out(found.where("variable <> 'exists_gaussian_unit_mode'"))


@query(f"""WITH {RECORDS}, {GRID}, l AS (SELECT track_id, step, lat, lon, unnest(['wind', 'pressure']) AS variable, unnest([wind, pressure]) AS v FROM r),
near AS (SELECT l.*, cell_lat, cell_lon, {_D} AS d FROM grid JOIN l ON abs(cell_lat - lat) < 15)
SELECT step, variable || '_disc' AS variable, cell_lat, cell_lon, CASE WHEN bool_or(isnan(v)) THEN 'NaN'::DOUBLE ELSE round(greatest(max(v), 0.0), 6) END + 0.0 AS value FROM near WHERE d < 1100 GROUP BY 1, 2, 3, 4
UNION ALL SELECT step, variable || '_sparse', (round((lat + 90) / 10) * 10 - 90), (round(lon / 10) * 10) % 360, round(arg_max(v, track_id), 6) + 0.0 FROM l GROUP BY 1, 2, 3, 4""")
def gridded_scalars(spark, sf_dir):
    return _out(gridding.scalars(records(spark, sf_dir), ["step"], "track_id", ["wind", "pressure"], 1100.0, CELL, core=False))


@query(f"WITH {RECORDS} SELECT step, bool_or(isnan(wind)) AS wind_has_nan, bool_or(isnan(pressure)) AS pressure_has_nan FROM r GROUP BY 1")
def gridded_missing(spark, sf_dir):
    return gridding.missing(records(spark, sf_dir), ["step"], ["wind", "pressure"])


@query(f"""WITH {RECORDS}, {GRID}, near AS (SELECT r.*, cell_lat, cell_lon, {_D} AS d FROM grid JOIN r ON abs(cell_lat - lat) < 15)
SELECT step, 'category_disc' AS variable, cell_lat, cell_lon, greatest(max(category + 6), 0.0) + 0.0 AS value FROM near WHERE d < 1100 GROUP BY 1, 3, 4
UNION ALL SELECT step, 'category_sparse', (round((lat + 90) / 10) * 10 - 90), (round(lon / 10) * 10) % 360, arg_max(category + 6, track_id) + 0.0 FROM r GROUP BY 1, 3, 4""")
def gridded_categories(spark, sf_dir):
    return _out(gridding.categories(records(spark, sf_dir), ["step"], "track_id", "category", 1100.0, CELL))


@query(f"""WITH {RECORDS}, {GRID}, k AS (SELECT *, list_filter(radii, lambda x: x IS NOT NULL) AS known FROM r),
f AS (SELECT *, list_transform(radii, lambda x: coalesce(x, CASE WHEN len(known) > 0 THEN list_sum(known) / len(known) ELSE 0.0 END)) AS full_radii, len(known) = 0 AND wind < 34 AS dark FROM k),
l AS (SELECT step, lat, lon, unnest(['ne', 'se', 'sw', 'nw']) AS q, unnest(full_radii) AS v FROM f), near AS (SELECT l.*, cell_lat, cell_lon FROM grid JOIN l ON abs(cell_lat - lat) < 15 AND {_D} < 1100),
sub AS (SELECT cell_lat AS c_lat, cell_lon AS c_lon, greatest(-90.0, least(90.0, cell_lat + ((i + 0.5) / 4 - 0.5) * 10)) AS cell_lat, (cell_lon + ((j + 0.5) / 4 - 0.5) * 10 + 360) % 360 AS cell_lon FROM grid, range(0, 4) v(i), range(0, 4) w(j)),
s AS (SELECT step, c_lat, c_lon, {_D} AS d, full_radii[CASE WHEN ((cell_lon - lon >= 0 AND cell_lon - lon < 180) OR cell_lon - lon < -180) AND cell_lat >= lat THEN 1
  WHEN (cell_lon - lon >= 0 AND cell_lon - lon < 180) OR cell_lon - lon < -180 THEN 2 WHEN cell_lat < lat THEN 3 ELSE 4 END] AS radius FROM sub JOIN f ON abs(cell_lat - lat) < 10),
c AS (SELECT step, c_lat AS cell_lat, c_lon AS cell_lon, count(*) / 16 AS covered FROM s WHERE d < radius GROUP BY 1, 2, 3),
x AS (SELECT DISTINCT step, cell_lat, cell_lon, true AS dark FROM grid JOIN f ON f.dark AND abs(cell_lat - lat) < 15 WHERE {_D} < 1100)
SELECT step, 'r34_' || q || '_radius_disc' AS variable, cell_lat, cell_lon, round(greatest(max(v), 0.0), 6) + 0.0 AS value FROM near GROUP BY 1, 2, 3, 4
UNION ALL SELECT step, 'r34_' || q || '_radius_sparse', (round((lat + 90) / 10) * 10 - 90), (round(lon / 10) * 10) % 360, round(arg_max(v, track_id), 6) + 0.0 FROM (SELECT track_id, step, lat, lon, unnest(['ne', 'se', 'sw', 'nw']) AS q, unnest(full_radii) AS v FROM f) GROUP BY 1, 2, 3, 4
UNION ALL SELECT step, 'r34_shape', cell_lat, cell_lon, CASE WHEN dark THEN 'NaN'::DOUBLE ELSE round(covered, 6) END FROM c FULL JOIN x USING (step, cell_lat, cell_lon)""")
def gridded_quadrants(spark, sf_dir):
    return _out(gridding.quadrants(records(spark, sf_dir), ["step"], "track_id", {"r34": ("radii", "wind", 34.0)}, 1100.0, 1100.0, CELL, core=False))


@query(f"""WITH {RECORDS}, {GRID}, m AS (SELECT min(step) AS a FROM fixes), t AS (SELECT r.* FROM r, m WHERE step BETWEEN a AND a + 19),
e AS (SELECT step, cell_lat, cell_lon, sum(exp(-0.5 * pow({_D} / 1000, 2))) AS v FROM grid, t GROUP BY 1, 2, 3),
near AS (SELECT t.*, cell_lat, cell_lon FROM grid JOIN t ON abs(cell_lat - lat) < 15 AND {_D} < 1100),
k AS (SELECT *, list_filter(radii, lambda x: x IS NOT NULL) AS known FROM near), f AS (SELECT *, unnest(['ne', 'se', 'sw', 'nw']) AS q, unnest(list_transform(radii, lambda x: coalesce(x, CASE WHEN len(known) > 0 THEN list_sum(known) / len(known) ELSE 0.0 END))) AS v FROM k),
every AS (SELECT step, 'exists_gaussian_unit_mode' AS variable, v FROM e UNION ALL SELECT step, 'wind_disc', max(wind) FROM near GROUP BY step, cell_lat, cell_lon
UNION ALL SELECT step, 'r34_' || q || '_radius_disc', max(v) FROM f GROUP BY step, q, cell_lat, cell_lon)
SELECT step, 'cyclone_' || variable AS variable, count(*) AS cells, round(sum(v), 4) AS total FROM every GROUP BY 1, 2""")
def gridded_range(spark, sf_dir):
    """All core families of the first 20 steps, summed up by step and variable."""
    rows = records(spark, sf_dir)
    first = rows.agg(F.min("step")).first()[0]
    found = gridding.gridded(rows, first or 0, (first or 0) + 19, CELL, 1000.0, ["wind"], 1100.0, "category", {"r34": ("radii", "wind", 34.0)}, 1100.0)
    return found.groupBy("step", "variable").agg(F.count(F.lit(1)).alias("cells"), F.round(F.sum("value"), 4).alias("total"))
