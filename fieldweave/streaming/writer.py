"""A store of one forecast that is written group of members by group of members, and published whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fields
from ..sources.tables import kept


class ForecastStore:
    """Frames (member, variable, step, value and the columns of a cell) staged as Parquet beside `path`.

    Batches come in order of members: each holds the next members, whole (all `steps`, if their number is given). Repeats,
    gaps, short groups and members beyond `members` are refused. A batch is written to a folder of its own number, so a
    batch that comes again after a failure replaces itself; its group is noted last. publish() adds the daily folds and
    moves all to `path` at once; until then, and after an error, only the staged folder is there. What the driver sees of a
    batch is a row a member.

    A staged folder that a lost driver left is taken up by a new object (`resume`, so that next_batch() tells where to go on):
    frames of a batch that was not noted count for nothing. Without `resume` it is deleted and the store starts clean."""

    def __init__(self, spark: SparkSession, path: str, members: int, steps: int | None = None, variables: list[str] | None = None, resume: bool = False):
        self.spark, self.path, self.staged, self.members, self.steps, self.variables = spark, path.rstrip("/"), f"{path.rstrip('/')}_partial", members, steps, variables
        if self._exists(self.path):
            raise ValueError(f"{self.path} is there already")
        if not resume and self._exists(self.staged):
            files, at = self._fs(self.staged)
            files.delete(at, True)

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _exists(self, path: str) -> bool:
        files, at = self._fs(path)
        return files.exists(at)

    def _noted(self) -> DataFrame:
        schema = "first int, last int, batch long"
        there = self._exists(f"{self.staged}/groups")
        return self.spark.read.schema(schema).parquet(f"{self.staged}/groups") if there else self.spark.createDataFrame([], schema)

    def _next_member(self, number: int) -> int:
        """The member after those of all batches before this one."""
        return self._noted().where(F.col("batch") < number).agg(F.coalesce(F.max("last") + 1, F.lit(0))).first()[0]

    def next_batch(self) -> tuple[int, int]:
        """The number of the batch after the last noted one, and the member that it starts with."""
        last, member = self._noted().agg(F.coalesce(F.max("batch") + 1, F.lit(0)), F.coalesce(F.max("last") + 1, F.lit(0))).first()
        return last, member

    def write_batch(self, batch: DataFrame, number: int) -> None:
        """One group of members; the function that foreachBatch takes. An empty batch counts for nothing."""
        if self.variables is not None:
            batch = batch.where(F.col("variable").isin(self.variables))
        batch = kept(batch)  # computed once, for the check and for the store
        seen = batch.groupBy("member").agg(F.count_distinct("step").alias("steps")).orderBy("member").collect()  # a row a member
        if not seen:
            return
        found, want = [r["member"] for r in seen], self._next_member(number)
        if found[0] != want:
            raise ValueError(f"members {found[0]} ... come where {want} is next: no repeats and no gaps")
        if found != list(range(found[0], found[0] + len(found))):
            raise ValueError(f"members {found} leave a gap")
        if found[-1] >= self.members:
            raise ValueError(f"member {found[-1]} of a forecast of {self.members}")
        if self.steps is not None and (short := [r["member"] for r in seen if r["steps"] != self.steps]):
            raise ValueError(f"members {short} do not have {self.steps} steps")
        batch.write.mode("overwrite").parquet(f"{self.staged}/frames/batch={number}")
        note = self.spark.range(1).select(F.lit(found[0]).alias("first"), F.lit(found[-1]).alias("last"))
        note.write.mode("overwrite").parquet(f"{self.staged}/groups/batch={number}")

    def publish(self, cell: list[str]) -> None:
        """Folds the frames of each cell to whole days and moves the store to its place; all members must be there."""
        if (n := self._next_member(1 << 62)) != self.members:
            raise ValueError(f"members {n} to {self.members - 1} were never written")
        noted = [r["batch"] for r in self._noted().select("batch").distinct().collect()]  # a row a batch
        files, at = self._fs(f"{self.staged}/frames")
        for folder in files.listStatus(at):
            if folder.getPath().getName() not in {f"batch={n}" for n in noted}:
                files.delete(folder.getPath(), True)
        frames = self.spark.read.parquet(f"{self.staged}/frames").drop("batch")
        fields.daily_fold(frames, ["member", "variable", *cell]).write.mode("overwrite").parquet(f"{self.staged}/daily")
        files, at = self._fs(self.staged)
        if not files.rename(at, self._fs(self.path)[1]):
            raise OSError(f"{self.staged} could not be moved to {self.path}")

    def frames(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/frames").drop("batch")

    def daily(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/daily")


def stream_into(store: ForecastStore, stream: DataFrame, state: str) -> None:
    """All that a stream of frames has, batch by batch, into a store; it stops at the first batch that the store refuses."""
    stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(store.write_batch).start().awaitTermination()


def merged(chunks: list[DataFrame], init, models: list[str], per_model: int, drop_prefix: str = "cyclone_") -> DataFrame:
    """Chunks of a forecast (member, variable, step ...) as one table, with the valid time and the model of each member;
    variables with the prefix are left out."""
    out = chunks[0]
    for c in chunks[1:]:
        out = out.unionByName(c)
    names = F.array(*map(F.lit, models))
    out = out.where(~F.startswith("variable", F.lit(drop_prefix)))
    hours = F.make_dt_interval(hours=(F.col("step") * 6).cast("int"))
    return out.withColumns({"valid": F.lit(init).cast("timestamp_ntz") + hours, "model": F.element_at(names, (F.expr(f"member div {per_model}") + 1).cast("int"))})
