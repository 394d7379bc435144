"""A whole forecast of one initial time in one call: conditions, members, rollouts of several models, folds, store."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import noise
from ..operators import fields, models
from ..sources.tables import kept
from .writer import ForecastStore, merged


@dataclass(frozen=True)
class Task:
    """What models predict and what they are given.

    Channels are the `surface` variables, then each `upper` variable at each of `levels`, named like `wind_850`; those of
    `may_lack` may have no value in a cell. `cell` names the columns of a place. Forcings are the `statics`, one value a
    cell, those of `derived` that `fields.with_derived` knows, and isotropic noise if `power` gives its power by degree."""

    surface: tuple[str, ...]
    cell: tuple[str, ...]
    upper: tuple[str, ...] = ()
    levels: tuple[int, ...] = ()
    may_lack: tuple[str, ...] = ()
    statics: tuple[str, ...] = ()
    derived: tuple[str, ...] = ()
    power: tuple[float, ...] = ()
    lat: str = "lat"
    lon: str = "lon"

    @property
    def channels(self) -> list[str]:
        return [*self.surface, *[f"{v}_{level}" for v in self.upper for level in self.levels]]

    @property
    def forced(self) -> bool:
        return bool(self.statics or self.derived or self.power)


def conditions(field: DataFrame, task: Task, init: int) -> DataFrame:
    """cell and `inputs` (see `models.stacked`) of one initial time, written to the shared folder: two frames.

    field: variable, step, cell, value, and level if the task has upper variables; statics may lie at any step. What is
    missing of a whole frame, and cells without a value at one of the two steps, are errors here, not NaN in a forecast."""
    spark = field.sparkSession
    one, lacks = spark.range(1).select(F.lit(init).cast("long").alias("init")), None
    for names, levels in ((task.surface, None), (task.upper, list(task.levels))):
        if names:
            needed = [n for n in names if n not in task.may_lack]
            some = fields.missing_inputs(field, one, needed, levels, task.statics if levels is None else ())
            lacks = some if lacks is None else lacks.unionByName(some)
    if lacks is None:
        raise ValueError("a task has a variable at least")
    if found := lacks.orderBy("variable", "level", "step").limit(5).collect():
        raise ValueError(f"initial time {init} lacks " + ", ".join(f"{r['variable']} (level {r['level']}, step {r['step']})" for r in found))
    rows = fields.initial_conditions(field, init, [*task.surface, *task.upper], list(task.levels) if task.upper else None, task.may_lack)
    if task.upper:
        at_level = F.col("variable").isin(list(task.upper))
        rows = rows.where(~at_level | F.col("level").isNotNull()).withColumn("variable", F.when(at_level, F.concat_ws("_", "variable", F.col("level").cast("string"))).otherwise(F.col("variable")))
    rows = kept(rows.select(*task.cell, "variable", "step", "value"))
    needed = [c for c in task.surface if c not in task.may_lack] + [f"{v}_{level}" for v in task.upper if v not in task.may_lack for level in task.levels]
    has = F.count_distinct(F.when(F.col("variable").isin(needed or [""]) & F.col("value").isNotNull(), F.struct("variable", "step")))
    whole = rows.groupBy(*task.cell).agg(has.alias("_has"), F.count_distinct("step").alias("_steps"))
    if short := whole.where((F.col("_has") < 2 * len(needed)) | (F.col("_steps") < 2)).limit(5).collect():
        raise ValueError(f"initial time {init} lacks values in cells " + ", ".join(str(tuple(r[c] for c in task.cell)) for r in short))
    return kept(models.stacked(rows, list(task.cell), "step", task.channels, 2))


def forcings(field: DataFrame, cells: DataFrame, task: Task, init: int, start: str, seed: int) -> DataFrame | None:
    """member, cell, lead, forcings of cells (member, cell, lead), or None if the task has none.

    Noise belongs to seed, initial time, member and lead, so a member draws the same in any group and any run. A cell
    without a static value is an error when it is read."""
    if not task.forced:
        return None
    if task.statics:
        value = [F.max(F.when(F.col("variable") == s, F.col("value").cast("double"))).alias(f"_static{i}") for i, s in enumerate(task.statics)]
        known = field.where(F.col("variable").isin(list(task.statics))).groupBy(*task.cell).agg(*value)
        cells = cells.join(known, list(task.cell), "left")
    at = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.lit(start).cast("timestamp_ntz")) + F.col("lead") * 6 * 3600
    place = F.col(task.lon) if task.lon in task.cell else F.lit(0.0)
    cells = fields.with_derived(cells, list(task.derived), at.cast("double"), place)
    lacks = F.raise_error(F.lit("a cell lacks a static value")).cast("double")
    parts = [F.coalesce(f"_static{i}", lacks) for i in range(len(task.statics))] + [F.col(c) for c in task.derived]
    if task.power:
        parts.append(noise.isotropic(F.col(task.lat), F.col(task.lon), noise.key_of(seed, F.lit(init), F.col("member"), F.col("lead")), list(task.power)))
    return cells.select("member", *task.cell, "lead", F.array(*[p.cast("double") for p in parts]).alias("forcings"))


class Forecast:
    """Runs a task: `per_model` members of each model, numbered through in order of the models' names as given.

    Members advance in groups of `group`, each of one model, `chunk` leads a table; a group's frames enter the store when its
    rollout is whole. With `frames` a model is given all cells of a member's frame at once (see `models.Rollout`)."""

    def __init__(self, task: Task, members: dict[str, models.Model], per_model: int, seed: int = 0, group: int | None = None, chunk: int = 4, frames: bool = False):
        self.task, self.models, self.per_model, self.seed, self.chunk = task, members, per_model, seed, chunk
        self.group, self.by = min(group or per_model, per_model), ["member"] if frames else None
        if per_model < 1 or not members:
            raise ValueError("a forecast has a model and a member at least")

    def groups(self) -> list[tuple[str, int, int]]:
        """(model, first member, the one after the last) of each group."""
        starts = [(name, a, (k + 1) * self.per_model) for k, name in enumerate(self.models) for a in range(k * self.per_model, (k + 1) * self.per_model, self.group)]
        return [(name, a, min(a + self.group, end)) for name, a, end in starts]

    def run(self, field: DataFrame, init: int, start: str, leads: int, path: str, resume: bool = False) -> ForecastStore:
        """The published store of the forecast from step `init`, whose time is `start`; its steps are leads 1 to `leads`.

        Run again with `resume` after a loss, it goes on after the last group in the store and that group's last whole
        chunk; a left-over of another forecast is refused. Without `resume` left-overs are deleted."""
        spark, task, path = field.sparkSession, self.task, path.rstrip("/")
        members = self.per_model * len(self.models)
        about = json.dumps({"init": init, "start": start, "leads": leads, "models": list(self.models), "per_model": self.per_model, "group": self.group, "seed": self.seed, "channels": task.channels})
        store, work = ForecastStore(spark, path, members, leads, resume=resume), f"{path}_work"
        if not resume:
            _delete(spark, work)
        note = f"{store.staged}/about"
        if store._exists(note):
            if (was := spark.read.text(note).first()) and was[0] != about:
                raise ValueError(f"{store.staged} holds another forecast: {was[0]}")
        else:
            _delete(spark, work)
            spark.range(1).select(F.lit(about).alias("value")).write.text(note)
        inputs = conditions(field, task, init)
        done, _ = store.next_batch()
        for number, (name, first, after) in list(enumerate(self.groups()))[done:]:
            some = inputs.withColumn("member", F.explode(F.sequence(F.lit(first), F.lit(after - 1))))
            ahead = some.select("member", *task.cell, F.explode(F.sequence(F.lit(1), F.lit(leads))).alias("lead"))
            folder = f"{work}/group={number}"
            rollout = models.Rollout(folder, self.models[name], ["member", *task.cell], self.chunk, self.by)
            found = models.unstacked(rollout.run(some, leads, forcings(field, ahead, task, init, start, self.seed)), task.channels)
            store.write_batch(found.select("member", "variable", F.col("lead").cast("long").alias("step"), *task.cell, "value"), number)
            _delete(spark, folder)
        store.publish(list(task.cell))
        _delete(spark, work)
        return store


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def published(spark: SparkSession, path: str, drop_prefix: str = "cyclone_") -> DataFrame:
    """The frames of a published forecast with `valid`, the time they are for, and `model`; variables with the prefix are
    left out."""
    about = json.loads(spark.read.text(f"{path.rstrip('/')}/about").first()[0])
    frames = spark.read.parquet(f"{path.rstrip('/')}/frames").drop("batch")
    return merged([frames], about["start"], about["models"], about["per_model"], drop_prefix)
