"""The store of chunks: exact round trips, reads that open what they need, and writes that fail."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

from fieldweave.sources import chunks, tables

AXES, CHUNK, SHARD = ["member", "step"], {"member": 2, "step": 10}, {"member": 2, "step": 3}


def field(spark, n=60):
    rows = [(m, s, float("nan") if s == 7 else m / 3 + s, f"x{s}" if s % 5 else None, [float(m), None]) for m in range(8) for s in range(-5, n - 5)]
    return spark.createDataFrame(rows, "member int, step long, value double, name string, parts array<double>").repartition(5)


@pytest.fixture(scope="module")
def path(spark):
    p = tables.shared_folder(spark, "chunks")
    chunks.write_chunks(field(spark), p, CHUNK, SHARD)
    return p


def plain(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_round_trip(spark, path):
    found = chunks.read_chunks(spark, path)
    assert found.schema == field(spark).schema and plain(found) == plain(field(spark))


def opened(path, *filters):
    reader = chunks._Reader(path)
    assert list(reader.pushFilters(list(filters))) == list(filters)  # Spark applies them again
    return sum(len(p.chunks) for p in reader.partitions())


def test_a_box_opens_only_chunks_that_meet_it(spark, path):
    assert opened(path) == 4 * 7  # steps -5 to 54 touch the chunks from -10 on
    assert opened(path, EqualTo(("member",), 3)) == 7
    assert opened(path, EqualTo(("member",), 3), GreaterThan(("step",), 29), LessThanOrEqual(("step",), 40)) == 3
    assert opened(path, In(("step",), (-3, 54, None))) == 8 and opened(path, EqualTo(("member",), 99)) == 0 and opened(path, EqualTo(("value",), 99.0)) == 28
    box = (F.col("member") == 3) & F.col("step").between(25, 41)
    assert plain(chunks.read_chunks(spark, path).where(box)) == plain(field(spark).where(box))
    assert chunks.read_chunks(spark, path).where("member > 50").count() == 0


def test_a_failed_write_leaves_nothing(spark, path):
    before = {p.name for p in Path(path).iterdir() if not p.name.startswith(".")}
    bad = field(spark).withColumn("value", F.when((F.col("member") == 7) & (F.col("step") == 54), F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        chunks.write_chunks(bad, path, CHUNK, SHARD)
    assert plain(chunks.read_chunks(spark, path)) == plain(field(spark))
    named = set(json.loads(Path(f"{path}/{chunks.MANIFEST}").read_text())["files"])
    assert {p.name for p in Path(path).iterdir() if p.name.startswith("part-")} == named <= before
    with pytest.raises(Exception, match="member is null"):
        chunks.write_chunks(field(spark).withColumn("member", F.lit(None).cast("int")), path, CHUNK, SHARD)


def test_appends_overwrites_and_damage(spark):
    p = tables.shared_folder(spark, "chunks")
    few = field(spark, 20)
    chunks.write_chunks(few.where("member < 4"), p, CHUNK, SHARD)
    chunks.write_chunks(few.where("member >= 4"), p, CHUNK, SHARD)
    assert plain(chunks.read_chunks(spark, p)) == plain(few)
    chunks.write_chunks(few.where("member = 0"), p, CHUNK, SHARD, overwrite=True)
    assert plain(chunks.read_chunks(spark, p)) == plain(few.where("member = 0"))
    (file,) = Path(p).glob("part-*")
    data = bytearray(file.read_bytes())
    data[40] ^= 1
    file.write_bytes(bytes(data))
    with pytest.raises(Exception, match="is damaged"):
        chunks.read_chunks(spark, p).count()
    empty = tables.shared_folder(spark, "chunks")
    chunks.write_chunks(few.where("false"), empty, CHUNK, SHARD)
    assert chunks.read_chunks(spark, empty).count() == 0


def test_a_shard_of_many_rows_is_cut(spark):
    """A shard, and even rows of equal axes, come from several tasks."""
    p, rows = tables.shared_folder(spark, "chunks"), spark.range(4000).select(F.lit(3).alias("member"), F.lit(70).cast("long").alias("step"), F.col("id").alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chunks.write_chunks(rows, p, CHUNK, SHARD)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in chunks.read_chunks(spark, p).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000
    assert plain(chunks.read_chunks(spark, p)) == plain(rows)


def test_a_chunk_of_many_rows_is_written_in_pieces(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(chunks, "PIECE_ROWS", 250)
    batch = pa.RecordBatch.from_pydict({"member": [1] * 100, "_shard": ["0"] * 100, "_chunk": ["0"] * 100})
    p = tables.shared_folder(spark, "chunks")
    writer = chunks._Writer(p, ["member"], False)
    writer.commit([writer.write(iter([batch] * 10))])
    reader = chunks._Reader(p)
    found = [b.num_rows for part in reader.partitions() for b in reader.read(part)]
    assert sum(found) == 1000 and len(reader.partitions()[0].chunks) == 4
