"""The daily fold as a stream: files in, watermarked windows out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.fields import DAY_STEPS
from ..sources.tables import shared_folder, ship


def daily_windows(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Count and extremes of each variable and day; rows later than the watermark are dropped, as streams need."""
    at = stream.withColumn("at", F.to_timestamp(F.col("ts").cast("string")))
    windows = at.withWatermark("at", delay).groupBy(F.window("at", "1 day"), "event_type")
    return windows.agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("greatest")).select(
        F.date_format("window.start", "yyyy-MM-dd").alias("day"), F.col("event_type").alias("variable"), "n", "least", "greatest"
    )


def run_once(spark: SparkSession, source: str, schema) -> DataFrame:
    """All files that are there, in one run that ends; the result is a table of the last state of each window."""
    folder, name = shared_folder(spark, "stream"), "daily"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")  # a batch that comes again replaces itself

    stream = spark.readStream.schema(schema).parquet(source)
    query = daily_windows(stream).writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    found = spark.read.schema("day string, variable string, n long, least double, greatest double, batch long").parquet(f"{folder}/{name}")
    return found.groupBy("day", "variable").agg(F.max_by("n", "n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))


_STATE = "steps int, n long, total double, least double, greatest double, bad boolean"


def _folding(names: list[str]):
    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        steps, n, total, least, greatest, bad = state.get if state.exists else (0, 0, 0.0, np.inf, -np.inf, False)
        for pdf in batches:
            values = pdf["value"].to_numpy(np.float64)
            steps |= int(np.bitwise_or.reduce(1 << ((pdf["step"].to_numpy(np.int64) - 1) % DAY_STEPS)))
            good = values[~np.isnan(values)]
            bad = bad or len(good) < len(values)
            n, total = n + len(good), total + float(good.sum())
            least, greatest = min(least, float(good.min(initial=np.inf))), max(greatest, float(good.max(initial=-np.inf)))
        state.update((steps, n, total, least, greatest, bad))
        if steps == (1 << DAY_STEPS) - 1:
            folds = [np.nan] * 4 if bad else [total / n, total, least, greatest]  # NaN leaves as null
            yield pd.DataFrame([[*key, DAY_STEPS, *folds]], columns=names)

    return fold


def whole_days(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The daily fold of a stream of (keys, step, value), as `fields.daily_fold`: a day appears once its four steps are
    there, in whatever order and batch they come, and again when more of it comes; the last one of a key and day holds.

    A day's state is six numbers, kept for good, so no row is ever too late."""
    types = {f.name: f.dataType.simpleString() for f in stream.schema}
    folds = [f"daily_{c}" for c in ("mean", "sum", "least", "greatest")]
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "day long", "steps long", *[f"{c} double" for c in folds]])
    rows = stream.select(*keys, F.floor((F.col("step") - 1) / DAY_STEPS).cast("long").alias("day"), "step", "value")
    return rows.groupBy(*keys, "day").applyInPandasWithState(_folding([*keys, "day", "steps", *folds]), schema, _STATE, "update", GroupStateTimeout.NoTimeout)


class DailyStore:
    """A folder of whole days that a stream writes: each batch to a folder of its own number, so that a batch that comes
    again after a failure replaces itself."""

    def __init__(self, spark: SparkSession, folder: str, keys: list[str]):
        self.spark, self.folder, self.keys = spark, folder.rstrip("/"), keys

    def write_batch(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.folder}/days/batch={number}")

    def run(self, stream: DataFrame) -> None:
        """All that the stream has; a later run goes on where this one, or a lost one, has stopped."""
        ship(self.spark)
        days = whole_days(stream, self.keys)
        days.writeStream.outputMode("update").option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).foreachBatch(self.write_batch).start().awaitTermination()

    def days(self) -> DataFrame:
        """The last fold of each key and day."""
        rows = self.spark.read.parquet(f"{self.folder}/days")
        names = [c for c in rows.columns if c not in (*self.keys, "day", "batch")]
        return rows.groupBy(*self.keys, "day").agg(F.max_by(F.struct(*names), "batch").alias("_d")).select(*self.keys, "day", "_d.*")
