"""What driver and executors share: intermediate tables in the common folder, and this package."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a session on a single machine
    gets a folder of its own; a cluster must name one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/fieldweave-{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession, name: str = "table") -> str:
    """A new name in the shared folder."""
    return f"{shared_base(spark)}/{uuid.uuid4().hex}/{name}"


def clear(spark: SparkSession) -> None:
    """Deletes what this application has left in the shared folder. Results that were not written elsewhere go with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_base(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """One row: files under a folder, or of a pattern, and their bytes; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def kept(df: DataFrame, by: str | None = None, name: str = "table", compression: str | None = None) -> DataFrame:
    """df written as Parquet and read again: its lineage ends there, and lost executors cost nothing."""
    path = shared_folder(df.sparkSession, name)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """df dealt evenly over as many tasks as shuffles have, before each row is multiplied: after a shuffle of few bytes
    adaptive execution would leave that to one task."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once a session."""
    context = spark.sparkContext
    if not getattr(context, "_fieldweave_shipped", False):
        root, file = Path(__file__).resolve().parent.parent, Path(tempfile.mkdtemp(prefix="spark-")) / "fieldweave.zip"
        with zipfile.ZipFile(file, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        context.addPyFile(str(file))
        context._fieldweave_shipped = True
