"""The tracker as a stream: frames in, in whatever order their cells come, tracks out."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import tracker
from ..sources.tables import ship

_BEFORE = ["was_lat", "was_lon"]


def framed(grid: DataFrame, initial: DataFrame | None = None, scalars: list[str] | None = None) -> DataFrame:
    """A grid and given centres (see `tracker.track`; `initial` needs its step) as the rows that a stream of tracks takes.

    Columns: run, step, `follows` (the step of the run's frame before; null for its first), `rows` (how many rows the frame
    has in all), cell_lat, cell_lon, p, the scalars, and for a given centre its track, was_lat and was_lon. A model that
    writes its frames one by one knows all of that; here it is counted."""
    values = list(scalars or [])
    nulls = {c: F.lit(None).cast("double") for c in _BEFORE}
    cells = grid.select("run", F.col("step").cast("long").alias("step"), "cell_lat", "cell_lon", "p", *values).withColumns({"track": F.lit(None).cast("string"), **nulls})
    if initial is not None:
        have = lambda c: (F.col(c) if c in initial.columns else F.lit(None)).cast("double").alias(c)
        given = initial.select("run", F.col("step").cast("long").alias("step"), F.col("lat").alias("cell_lat"), F.pmod("lon", F.lit(360.0)).alias("cell_lon"), F.lit(0.0).alias("p"), *[have(c) for c in values], "track", *[have(c) for c in _BEFORE])
        cells = cells.unionByName(given)
    frames = cells.groupBy("run", "step").agg(F.count(F.lit(1)).alias("rows"))
    frames = frames.withColumn("follows", F.lag("step").over(W.partitionBy("run").orderBy("step")))
    return cells.join(frames, ["run", "step"])


@dataclass
class _Waiting:
    """What has come of a frame: its given centres and cells with p > 0, and how many rows in all."""

    follows: int | None
    rows: int
    come: int = 0
    given: list[pd.DataFrame] = field(default_factory=list)
    cells: list[pd.DataFrame] = field(default_factory=list)


def _walking(settings: tracker.Settings, every: int, scalars: list[str], names: list[str]):
    def taken(run: tracker.Run, waiting: dict[int, _Waiting], pdf: pd.DataFrame) -> None:
        for step, rows in pdf.groupby("step", sort=False):
            if run.step is not None and step <= run.step:
                raise ValueError(f"rows of step {step} come after the walk has passed {run.step}")
            before = rows["follows"].iloc[0]
            frame = waiting.setdefault(int(step), _Waiting(None if pd.isna(before) else int(before), int(rows["rows"].iloc[0])))
            frame.come += len(rows)
            if frame.come > frame.rows:
                raise ValueError(f"step {step} has more than its {frame.rows} rows")
            known = rows["track"].notna()
            frame.given.append(rows[known].rename(columns={"cell_lat": "lat", "cell_lon": "lon"})[["track", "lat", "lon", *_BEFORE, *scalars]])
            frame.cells.append(rows[~known & (rows["p"] > 0)].rename(columns={"cell_lat": "lat", "cell_lon": "lon"})[["lat", "lon", "p", *scalars]])

    def walk(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, waiting = pickle.loads(state.get[0]) if state.exists else (tracker.Run(settings, every), {})
        for pdf in batches:
            taken(run, waiting, pdf)
        out = {}
        while (step := next((s for s, f in waiting.items() if f.follows == run.step and f.come == f.rows), None)) is not None:
            frame = waiting.pop(step)
            given = pd.concat(frame.given)
            for at, c in run.advance(step, tracker.frame_of(pd.concat(frame.cells), scalars, frame.rows - len(given)), tracker.centres_of(given, scalars)):
                out[at, c.track] = c
            out |= {(step, c.track): c for c in run.active}
        state.update((pickle.dumps((run, waiting)),))
        if out:
            yield pd.DataFrame([(key[0], c.track, at, c.lat, c.lon, c.existence, c.merged_into, *map(float, c.scalars)) for (at, _), c in out.items()], columns=names)

    return walk


def tracked(stream: DataFrame, settings: tracker.Settings = tracker.Settings(), scalars: list[str] | None = None, every: int = 1) -> DataFrame:
    """The rows of `tracker.track` from a stream of `framed` rows, new tracks however short among them.

    A run is a key of state: its centres, and the cells with p > 0 of frames that are not whole yet or whose frame before
    is not; no frame is held once it was walked through. A centre's row leaves with its frame and once more with the next,
    which tells whether it merges: the last one of a run, track and step holds. Rows of frames that were passed, and more
    rows than a frame has, are errors, so nothing is dropped unseen."""
    values, run_type = list(scalars or []), stream.schema["run"].dataType.simpleString()
    schema = f"run {run_type}, track string, step long, lat double, lon double, existence double, merged_into string" + "".join(f", `{c}` double" for c in values)
    names = ["run", "track", "step", "lat", "lon", "existence", "merged_into", *values]
    number = lambda c: F.col(c).cast("double").alias(c)
    probability = F.coalesce(F.nanvl(number("p"), F.lit(0.0)), F.lit(0.0)).alias("p")
    rows = stream.select("run", F.col("step").cast("long").alias("step"), F.col("follows").cast("long").alias("follows"), F.col("rows").cast("long").alias("rows"), number("cell_lat"), number("cell_lon"), probability, "track", *[number(c) for c in (*_BEFORE, *values)])
    return rows.groupBy("run").applyInPandasWithState(_walking(settings, every, values, names), schema, "walk binary", "update", GroupStateTimeout.NoTimeout)


class TrackStore:
    """A folder of tracks that a stream writes: each batch to a folder of its own number, so that a batch that comes again
    after a failure replaces itself."""

    def __init__(self, spark: SparkSession, folder: str, settings: tracker.Settings = tracker.Settings(), scalars: list[str] | None = None, every: int = 1):
        self.spark, self.folder, self.settings, self.scalars, self.every = spark, folder.rstrip("/"), settings, scalars, every

    def write_batch(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.folder}/tracks/batch={number}")

    def run(self, stream: DataFrame) -> None:
        """All that the stream has; a later run goes on where this one, or a lost one, has stopped."""
        ship(self.spark)
        rows = tracked(stream, self.settings, self.scalars, self.every)
        rows.writeStream.outputMode("update").option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).foreachBatch(self.write_batch).start().awaitTermination()

    def tracks(self, settled: bool = True) -> DataFrame:
        """The tracks so far, equal to those of the batch once all frames came. `settled` leaves out new ones that are still
        too short; for a run that goes on they may yet last."""
        rows = self.spark.read.parquet(f"{self.folder}/tracks")
        names = [c for c in rows.columns if c not in ("run", "track", "step", "batch")]
        last = rows.groupBy("run", "track", "step").agg(F.max_by(F.struct(*names), "batch").alias("_c")).select("run", "track", "step", "_c.*")
        return tracker.lasting(last, self.settings) if settled else last
