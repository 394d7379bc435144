"""Rollouts of models that are functions of arrays: frames in, the next frame out, chunk by chunk, each chunk a table."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import ship


class Model(Protocol):
    """The next frame of some rows.

    inputs: [rows, frames, channels], the newest frame last; forcings: [rows, values] of the step that is predicted; step:
    its number, from 1. Returns [rows, channels]. Rows are those of one Arrow batch, in no given order, or where a rollout
    has `by`, all rows of one frame, in order of its keys."""

    def __call__(self, inputs: np.ndarray, forcings: np.ndarray, step: int) -> np.ndarray: ...


def stacked(field: DataFrame, keys: list[str], order: str, variables: list[str], frames: int) -> DataFrame:
    """keys and `inputs`: the channels (variables in the order given, NaN where one is missing) of the last `frames` steps
    that a key has, as arrays in order of the step. A key with fewer steps has no row."""
    rows = field.where(F.col("variable").isin(variables))
    # Only the numbers of a key's steps are ranked, not its values.
    age = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))
    newest = rows.select(*keys, order).distinct().withColumn("_age", age).where(F.col("_age") <= frames)
    channels = F.array(*[F.coalesce(F.max(F.when(F.col("variable") == v, F.col("value").cast("double"))), F.lit(float("nan"))) for v in variables])
    whole = rows.join(newest, [*keys, order]).groupBy(*keys, "_age").agg(channels.alias("_c"))
    last = whole.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct((-F.col("_age")).alias("at"), "_c"))).alias("_last"))
    return last.where(F.size("_last") == frames).select(*keys, F.transform("_last", lambda f: f["_c"]).alias("inputs"))


def _advanced(pdf: pd.DataFrame, model: Model, keys: list[str], first: int, steps: int) -> pd.DataFrame:
    inputs = np.array([np.stack([np.asarray(c, float) for c in frames]) for frames in pdf["inputs"]])
    given = {n: [f[n] for f in pdf["forcings"]] for n in range(steps)}
    out = []
    for n in range(steps):
        forcing = np.array([np.asarray(f, float) for f in given[n]])
        new = np.asarray(model(inputs, forcing, first + n), float)
        if new.shape != inputs[:, 0].shape:
            raise ValueError(f"a model gave {new.shape} where {inputs[:, 0].shape} was expected")
        inputs = np.concatenate([inputs[:, 1:], new[:, None]], axis=1)
        frames = [list(f) for f in inputs] if n == steps - 1 else None
        out.append(pdf[keys].assign(lead=first + n, channels=list(new), inputs=frames))
    return pd.concat(out, ignore_index=True)


def _of_frames(model: Model, keys: list[str], first: int, steps: int):
    return lambda pdf: _advanced(pdf.sort_values(keys, ignore_index=True), model, keys, first, steps)


def _of_batches(model: Model, keys: list[str], first: int, steps: int):
    def advance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield _advanced(pdf, model, keys, first, steps)

    return advance


class Rollout:
    """Predictions fed back as inputs, `chunk` steps at a time.

    Each chunk is a table under `folder` (keys, lead, channels, and at its last lead the inputs of the next chunk), complete
    once Spark has committed it; so a rollout that lost its driver goes on after its last whole chunk when it is run again
    with the same folder. Rows lie in batches of the executors; with `by` all rows of a frame, such as an init and a member,
    meet in one task in order of the keys, for models that look around: a frame must fit there."""

    def __init__(self, folder: str, model: Model, keys: list[str], chunk: int, by: list[str] | None = None):
        self.folder, self.model, self.keys, self.chunk, self.by = folder.rstrip("/"), model, keys, chunk, by
        if chunk < 1:
            raise ValueError("a chunk has a step at least")

    def _whole(self, spark, path: str) -> bool:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)

    def run(self, inputs: DataFrame, steps: int, forcings: DataFrame | None = None) -> DataFrame:
        """keys, lead, channels of leads 1 to steps. inputs: keys, inputs (see `stacked`); forcings: keys, lead, forcings (an
        array), needed for each key and lead, or none at all."""
        spark, model, keys, by = inputs.sparkSession, self.model, self.keys, self.by
        ship(spark)
        types = {f.name: f.dataType.simpleString() for f in inputs.schema}
        schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", lead int, channels array<double>, inputs array<array<double>>"
        state = inputs.select(*keys, "inputs")
        paths = []
        for first in range(1, steps + 1, self.chunk):
            n = min(self.chunk, steps + 1 - first)
            path = f"{self.folder}/leads={first:06d}-{first + n - 1:06d}"
            if not self._whole(spark, path):
                rows = self._forced(state, forcings, first, n)
                if by:
                    out = rows.groupBy(*by).applyInPandas(_of_frames(model, keys, first, n), schema)
                else:
                    out = rows.mapInPandas(_of_batches(model, keys, first, n), schema)
                out.write.mode("overwrite").parquet(path)
            paths.append(path)
            state = spark.read.schema(schema).parquet(path).where(F.col("lead") == first + n - 1).select(*keys, "inputs")
        if not paths:
            return spark.createDataFrame([], schema).drop("inputs")
        nan = F.transform("channels", lambda x: F.coalesce(x, F.lit(float("nan"))))  # Arrow has turned them to nulls
        return spark.read.schema(schema).parquet(*paths).select(*keys, "lead", nan.alias("channels"))

    def _forced(self, state: DataFrame, forcings: DataFrame | None, first: int, n: int) -> DataFrame:
        if forcings is None:
            return state.withColumn("forcings", F.array_repeat(F.array().cast("array<double>"), n))
        some = forcings.where(F.col("lead").between(first, first + n - 1)).groupBy(*self.keys).agg(F.sort_array(F.collect_list(F.struct("lead", "forcings"))).alias("_f"))  # a chunk's
        met = state.join(some, self.keys, "left")
        whole = F.when(F.size("_f") == n, F.transform("_f", lambda f: f["forcings"])).otherwise(F.raise_error(F.lit("a lead lacks its forcings")).cast("array<array<double>>"))
        return met.withColumn("forcings", whole).drop("_f")


def unstacked(predictions: DataFrame, variables: list[str]) -> DataFrame:
    """A row a variable: `variable` and `value` in place of `channels`."""
    rest = [c for c in predictions.columns if c != "channels"]
    pairs = F.arrays_zip(F.array(*map(F.lit, variables)).alias("variable"), F.col("channels").alias("value"))
    return predictions.select(*rest, F.inline(pairs))
