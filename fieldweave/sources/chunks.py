"""A store of chunks as a data source of Spark: `spark.read.format("fieldweave_chunks")`, after `register(spark)`.

Rows have whole-number axes; a chunk is a box of them and a shard a box of chunks. A task writes one file, chunk after
chunk, with an index behind them: each chunk's place, bytes, checksum and the least and greatest number of each axis. A
shard of many rows is written by several tasks, and a chunk of many rows in pieces, each with its own entry. A
manifest, written last, names the files that count, so a write that fails leaves nothing that is read, and its files are
deleted. A read opens only chunks that its filters on axes can meet, and checks them."""

from __future__ import annotations

import json
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

NAME, MANIFEST = "fieldweave_chunks", "_manifest.json"
#: Bytes behind the index that tell its length.
_TAIL = 8
#: Rows of a piece of a chunk, at most those of a batch more.
PIECE_ROWS = 1 << 17


def _at(path: str):
    """The file system of a path and the path in it."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _read(path: str) -> bytes | None:
    from pyarrow import fs

    files, inner = _at(path)
    if files.get_file_info(inner).type == fs.FileType.NotFound:
        return None
    with files.open_input_stream(inner) as source:
        return source.read()


def _write(path: str, data: bytes) -> None:
    files, inner = _at(path)
    files.create_dir(inner.rpartition("/")[0], recursive=True)
    with files.open_output_stream(inner) as sink:
        sink.write(data)


@dataclass
class _Written(WriterCommitMessage):
    file: str | None


@dataclass
class _Shard(InputPartition):
    """The chunks of one file that a read wants: (offset, bytes, checksum)."""

    path: str
    chunks: list[tuple[int, int, int]]


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, axes: list[str], overwrite: bool):
        self.path, self.axes, self.overwrite = path, axes, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        """Rows come sorted by _shard and _chunk; a chunk ends where the next begins."""
        name, index, sink, held, here, place = f"part-{uuid.uuid4().hex}", [], None, [], None, 0
        files, inner = _at(f"{self.path}/{name}")

        def close() -> int:
            whole = pa.Table.from_batches(held).combine_chunks()
            bounds = {a: [whole[a].to_numpy().min().item(), whole[a].to_numpy().max().item()] for a in self.axes}
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(whole)
            data = out.getvalue().to_pybytes()
            sink.write(data)
            index.append([place, len(data), zlib.crc32(data), bounds])
            return place + len(data)

        try:
            for batch in iterator:
                keys = list(zip(batch.column("_shard").to_pylist(), batch.column("_chunk").to_pylist(), strict=True))
                rest = batch.select([c for c in batch.schema.names if c not in ("_shard", "_chunk")])
                starts = [i for i, k in enumerate(keys) if i == 0 or k != keys[i - 1]]
                for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
                    if sink is None:
                        files.create_dir(inner.rpartition("/")[0], recursive=True)
                        sink = files.open_output_stream(inner)
                    if held and (keys[a] != here or sum(map(len, held)) >= PIECE_ROWS):
                        place, held = close(), []
                    here = keys[a]
                    held.append(rest.slice(a, b - a))
            if held:
                place, held = close(), []
            if sink is None:
                return _Written(None)
            tail = json.dumps(index).encode()
            sink.write(tail + len(tail).to_bytes(_TAIL, "little"))
            sink.close()
        except BaseException:
            if sink is not None:
                sink.close()
                files.delete_file(inner)
            raise
        return _Written(name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        old = json.loads(_read(f"{self.path}/{MANIFEST}") or b'{"files": []}')["files"]
        new = [m.file for m in messages if m is not None and m.file]
        _write(f"{self.path}/{MANIFEST}", json.dumps({"files": new if self.overwrite else old + new, "axes": self.axes}).encode())
        self._delete(old if self.overwrite else [])

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._delete([m.file for m in messages if m is not None and m.file])

    def _delete(self, names: list[str]) -> None:
        for name in names:
            files, inner = _at(f"{self.path}/{name}")
            files.delete_file(inner)


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.limits, self.sets = path, [], []

    def pushFilters(self, filters: list) -> Iterator:
        """Notes what filters say of axes; Spark still applies all of them to the rows of the chunks that are left."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column and isinstance(f, EqualTo):
                self.limits += [(column, f.value, f.value)]
            elif column and isinstance(f, In):
                self.sets += [(column, [v for v in f.value if v is not None])]
            elif column and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.limits += [(column, f.value, None)]
            elif column and isinstance(f, LessThan | LessThanOrEqual):
                self.limits += [(column, None, f.value)]
            yield f

    def _meets(self, bounds: dict[str, list[int]]) -> bool:
        for column, least, most in self.limits:
            if column in bounds and ((least is not None and bounds[column][1] < least) or (most is not None and bounds[column][0] > most)):
                return False
        return all(column not in bounds or any(bounds[column][0] <= v <= bounds[column][1] for v in values) for column, values in self.sets)

    def partitions(self) -> list[InputPartition]:
        manifest, out = json.loads(_read(f"{self.path}/{MANIFEST}") or b'{"files": []}'), []
        for name in manifest["files"]:
            files, inner = _at(f"{self.path}/{name}")
            with files.open_input_file(inner) as source:
                size = source.size()
                source.seek(size - _TAIL)
                length = int.from_bytes(source.read(_TAIL), "little")
                source.seek(size - _TAIL - length)
                index = json.loads(source.read(length))
            chunks = [(place, n, crc) for place, n, crc, bounds in index if self._meets(bounds)]
            if chunks:
                out.append(_Shard(f"{self.path}/{name}", chunks))
        return out or [_Shard("", [])]

    def read(self, partition: _Shard) -> Iterator[pa.RecordBatch]:
        if not partition.chunks:
            return
        files, inner = _at(partition.path)
        with files.open_input_file(inner) as source:
            for place, n, crc in partition.chunks:
                source.seek(place)
                data = source.read(n)
                if zlib.crc32(data) != crc:
                    raise ValueError(f"a chunk of {partition.path} at {place} is damaged")
                yield from pa.ipc.open_stream(data)


class ChunkSource(DataSource):
    """Options: path; for writing axes, a comma-separated list. The schema is given by the reader or lies in `<path>/_schema.json`."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        from pyspark.sql.types import StructType

        return StructType.fromJson(json.loads(_read(f"{self.options['path']}/_schema.json")))

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], self.options["axes"].split(","), overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, with filters pushed into it."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers that plan a read do not see this package
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ChunkSource)


def write_chunks(df: DataFrame, path: str, chunk: dict[str, int], shard: dict[str, int], overwrite: bool = False) -> None:
    """Writes df: `chunk` gives each axis' numbers a chunk, `shard` its chunks a shard. Rows are cut into ranges in
    order of their shards and chunks, those of equal axes by a hash, so that no task gets a whole shard of many rows; a null
    on an axis is an error."""
    register(df.sparkSession)
    axes = list(chunk)
    number = {a: F.coalesce(F.floor(F.col(a) / chunk[a]), F.raise_error(F.lit(f"{a} is null")).cast("long")).cast("long") for a in axes}
    keyed = df.withColumn("_chunk", F.concat_ws("_", *[number[a] for a in axes])).withColumn("_shard", F.concat_ws("_", *[F.floor(number[a] / shard[a]) for a in axes]))
    by = ["_shard", "_chunk", *axes]
    hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]  # maps have no hash
    ordered = keyed.repartitionByRange(*by, F.xxhash64(*hashed)).sortWithinPartitions(*by)
    _write(f"{path}/_schema.json", json.dumps(df.schema.jsonValue()).encode())
    ordered.write.format(NAME).option("path", path).option("axes", ",".join(axes)).mode("overwrite" if overwrite else "append").save()


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format(NAME).option("path", path).load()
