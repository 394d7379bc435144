"""Best tracks from raw records: cells, lists of times, names, quadrants with a margin."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldweave.operators import besttracks, spheres

FIX = "struct<time: timestamp_ntz, lat: {0}, lon: double, pressure: double, wind: {0}, rmw: float, r34: array<{0}>, r50: array<double>, r64: array<float>>"


@pytest.mark.parametrize("kind, made", [("string", str), ("binary", str.encode), ("double", float)])
def test_cells_of_any_type(spark, kind, made):
    t = dt.datetime(2020, 12, 31, 18)
    good = (t, made("10.5"), -30.0, 990.0, made("50"), 20.0, [made("54.0"), None], [float("nan")] * 4, None)
    rows = [
        ("a", [good, (None, *good[1:]), (t + dt.timedelta(hours=1), *good[1:]), (t, made("nan"), *good[2:]), (dt.datetime(2021, 1, 1), *good[1:])]),
        ("b", []), ("c", None), ("d", [(t.replace(year=2019), *good[1:])]),
    ]
    storms = spark.createDataFrame(rows, f"sid string, fixes array<{FIX.format(kind)}>")
    if kind == "binary":
        storms = storms.withColumn("sid", F.col("sid").cast("binary"))
    out = besttracks.converted(storms, 2020).collect()
    assert [(r["track_id"], r["time"], r["lat"], r["lon"], r["wind"]) for r in out] == [("a", t, 10.5, 330.0, 50.0)]
    one = out[0]
    assert one["rmw_km"] == pytest.approx(37.04, abs=1e-3) and one["r34_ne_km"] == pytest.approx(100.008, abs=1e-3)
    assert [one[f"r34_{q}_km"] for q in ("se", "sw", "nw")] == [None] * 3 and one["r50_ne_km"] is None and one["r64_nw_km"] is None
    assert besttracks.converted(storms, [2019, 2021]).count() == 2
    assert besttracks.converted(storms, 2020, (18, 19)).count() == 2


def test_blank_numbers(spark):
    storms = spark.createDataFrame([("a", [(dt.datetime(2020, 1, 1), " 1 ", 2.0, None, " ", None, ["x"], [], [])])], f"sid string, fixes array<{FIX.format('string')}>")
    (row,) = besttracks.converted(storms, 2020).collect()
    assert row["lat"] == 1 and row["wind"] is None and row["r34_ne_km"] is None and row["rmw_km"] is None


def test_lines_of_times(spark):
    lines = spark.createDataFrame([("# all",), ("",), (" 2020-01-01 # first # of all",), ("2020-01-01 00:00",), ("2020-02-29T12:00",), (None,)], "value string")
    found = sorted(r["init"] for r in besttracks.init_times(lines).collect())
    assert found == [dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 29, 12)]
    with pytest.raises(PySparkException, match="no time: 2021-02-29"):
        besttracks.init_times(spark.createDataFrame([("2021-02-29 # none",)], "value string")).collect()


def test_names(spark):
    rows = [("existence", None), ("existence", "usa"), ("scalar", "usa_wind"), ("shape", "usa_r34"), ("scalar", "usa_wind"), ("other", "x")]
    found = {r["name"] for r in besttracks.gridded_names(spark.createDataFrame(rows, "kind string, variable string")).collect()}
    assert len(found) == 4 + 4 + 2 + 1 and {"cyclone_exists_disc", "cyclone_usa_exists_sparse", "cyclone_usa_wind_disc", "cyclone_usa_r34_shape"} <= found


def test_quadrants_with_a_margin(spark):
    rows = [(1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0), (1.0, -1.0), (0.0, 359.0)]
    km = 157.2  # of all but the last, which is 111.2 away in the north-west
    table = spark.createDataFrame(rows, "lat double, lon double").coalesce(1)
    radii = F.array(F.lit(km - 1), F.lit(km + 1), F.lit(float("nan")), F.lit(None).cast("double"))
    inside = lambda margin, of=radii: [r[0] for r in table.select(spheres.in_quadrants(F.col("lat"), F.col("lon"), F.lit(0.0), F.lit(0.0), of, margin)).collect()]
    assert inside(0.0) == [False, True, False, False, False] and inside(2.0) == [True, True, False, False, False]
    assert inside(200.0, F.array(*[F.lit(0.0)] * 4)) == [True] * 5
