"""Whole forecasts: conditions, groups, resuming, noise, folds."""

import math
import uuid

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldweave.sources.tables import shared_folder
from fieldweave.streaming import forecast

CELLS = [(lat, lon) for lat in (-45.0, 0.0, 45.0) for lon in (0.0, 120.0)]
TASK = forecast.Task(("t",), ("lat", "lon"), ("u",), (500, 850), ("u",), ("z",), ("day_progress",), (0.5, 0.5))


def _models():
    """Functions that workers get whole, as they cannot import the tests."""

    def model(inputs, forced, lead):
        return inputs[:, 1] + 0.5 * inputs[:, 0] + forced[:, 2:] + forced[:, :1] + lead * forced[:, 1:2]

    def other(inputs, forced, lead):
        return 0.5 * model(inputs, forced, lead)

    def broken(inputs, forced, lead):
        raise ValueError("this model is lost")

    return model, other, broken


model, other, broken = _models()


@pytest.fixture(scope="module")
def record(spark):
    rows = [("t", None, step, lat, lon, lat / 9 + step) for step in (9, 10) for lat, lon in CELLS]
    rows += [("u", level, step, lat, lon, math.nan if (lat, level) == (0.0, 850) else level / 100 + lon / 60) for level in (500, 850, 1000) for step in (8, 9, 10) for lat, lon in CELLS]
    rows += [("z", None, 0, lat, lon, lat / 45) for lat, lon in CELLS]
    return spark.createDataFrame(rows, "variable string, level int, step long, lat double, lon double, value double").coalesce(1)


def run(spark, record, members, path=None, resume=False, **more):
    path = path or shared_folder(spark, f"f{uuid.uuid4().hex}")
    store = forecast.Forecast(TASK, members, 2, 3, **more).run(record, 10, "2024-02-28 18:00:00", 6, path, resume)
    return path, store


def values(frames):
    return {(r["member"], r["variable"], r["step"], r["lat"], r["lon"]): r["value"] for r in frames.collect()}


@pytest.fixture(scope="module")
def whole(spark, record):
    return run(spark, record, {"a": model, "b": other}, chunk=6)


def test_groups_do_not_change_a_forecast(spark, record, whole):
    path, store = whole
    _, small = run(spark, record, {"a": model, "b": other}, group=1, chunk=4, frames=True)
    one, two = values(store.frames()), values(small.frames())
    assert len(one) == 4 * 3 * 6 * 6 and one.keys() == two.keys()
    assert all(math.isclose(one[k], two[k], abs_tol=1e-9) or math.isnan(one[k]) and math.isnan(two[k]) for k in one)
    assert {k[1] for k in one} == {"t", "u_500", "u_850"}
    assert {k[3] for k, v in one.items() if math.isnan(v)} == {0.0} and {k[1] for k, v in one.items() if math.isnan(v)} == {"u_850"}
    assert one[0, "t", 1, 45.0, 0.0] != one[1, "t", 1, 45.0, 0.0]  # members draw their own noise
    assert one[2, "t", 1, 45.0, 0.0] != 0.5 * one[0, "t", 1, 45.0, 0.0]
    rows = forecast.published(spark, path, "u_").select("member", "step", F.date_format("valid", "MM-dd HH").alias("valid"), "model", "variable").distinct().collect()
    assert {(r["step"], r["valid"]) for r in rows} == {(1, "02-29 00"), (2, "02-29 06"), (3, "02-29 12"), (4, "02-29 18"), (5, "03-01 00"), (6, "03-01 06")}
    assert {(r["member"], r["model"]) for r in rows} == {(0, "a"), (1, "a"), (2, "b"), (3, "b")} and {r["variable"] for r in rows} == {"t"}
    day = next(r for r in store.daily().collect() if (r["member"], r["variable"], r["lat"], r["lon"]) == (3, "t", 45.0, 120.0))
    assert day["day"] == 0 and math.isclose(day["daily_mean"], np.mean([one[3, "t", s, 45.0, 120.0] for s in (1, 2, 3, 4)]), rel_tol=1e-9)


def test_a_lost_forecast_goes_on(spark, record, whole):
    path = shared_folder(spark, "lost")
    with pytest.raises(PySparkException):
        run(spark, record, {"a": model, "b": broken}, path)
    with pytest.raises(ValueError, match="holds another forecast"):
        forecast.Forecast(TASK, {"a": model, "b": other}, 2, 4).run(record, 10, "2024-02-28 18:00:00", 6, path, True)
    # The first model's members are in the store: what now calls itself "a" is never run.
    _, store = run(spark, record, {"a": broken, "b": other}, path, True)
    got, want = values(store.frames()), values(whole[1].frames())
    assert got.keys() == want.keys() and np.allclose([got[k] for k in want], list(want.values()), equal_nan=True)
    with pytest.raises(ValueError, match="is there already"):
        run(spark, record, {"a": model}, path)


@pytest.mark.parametrize(
    "gone, told",
    [("variable = 't' and step = 9", r"lacks t \(level None, step 9\)"), ("variable = 't' and step = 9 and lat = 45", "lacks values in cells"), ("variable = 'z'", "lacks z")],
)
def test_conditions_are_checked(spark, record, gone, told):
    with pytest.raises(ValueError, match=told):
        run(spark, record.where(f"not ({gone})"), {"a": model})


def test_nan_where_none_may_be(spark, record):
    bad = record.withColumn("value", F.when((F.col("variable") == "t") & (F.col("lat") == 0) & (F.col("step") == 10), float("nan")).otherwise(F.col("value")))
    with pytest.raises(PySparkException, match="NaN in t"):
        run(spark, bad, {"a": model})
    with pytest.raises(PySparkException, match="static"):
        run(spark, record.where("not (variable = 'z' and lat = 45)"), {"a": model})
