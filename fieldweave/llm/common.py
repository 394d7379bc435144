"""Helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import kept, shared_folder, ship

#: The word pattern of the text operators: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def fresh_path(spark: SparkSession, name: str) -> str:
    return shared_folder(spark, name)


def as_table(df: DataFrame, name: str, compression: str | None = None, by: str | None = None) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it again: the lineage ends there and lost executors cost nothing."""
    return kept(df, by, name, compression)


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package wherever they run, and keeps Arrow batches, whose rows hold whole texts,
    at BATCH_ROWS rows if nobody has set a number."""
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    ship(spark)


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id falls in no fold (-1)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % folds, F.lit(-1))


def unit_hash(*cols: Column | str) -> Column:
    """A hash of the columns as a double in [0, 1)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)


def carried(docs: DataFrame, **columns: Column) -> DataFrame:
    """The rows of docs, whole, as the struct `row`, and columns that are computed of them: whatever names docs has, none clashes."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(name) for name, c in columns.items()])
