"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames of about FRAME_BYTES; a skippable frame at the end of a bundle is the seek
table (the Zstandard seekable format: sizes of all frames, their number, a magic number). The index maps each record to
its bundle, frame and offset in the frame, so that one record is read by one ranged read and one frame. A record's
identifier names its page and payload; rows that agree in both are the same record, written as often as it occurs.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_table, fresh_path, ship_package

FRAME_BYTES, LEVEL = 1 << 19, 3
#: A payload of more pages than HOT_PAGES, and than the HOT_PAYLOADS-th part of all, is broadcast.
HOT_PAGES, HOT_PAYLOADS = 1 << 14, 1000
DATE = "2024-01-01T00:00:00Z"
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:fieldweave:page:"


def filesystem(path: str):
    """pyarrow's file system of a path or URI, and the path in it; it is the same on the driver and on executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def identifier(page_id: int | None, digest: str) -> str:
    return f"<{_URN}{'' if page_id is None else page_id}:{digest}>"


def record(page_id: int | None, url: str | None, payload: bytes, length: int, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record of the page refers_to, whose payload is not needed but for its length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {identifier(page_id, digest)}", f"WARC-Date: {DATE}"]
    if uri:
        head.append(f"WARC-Target-URI: {uri}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {identifier(refers_to, digest)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers (lower case) and block of the record at an offset, and the offset after it."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record here")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    start = end + 4
    stop = start + int(headers["content-length"])
    return headers, data[start:stop], stop + 4


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix(_URN).partition(":")[0]
    return int(number) if number else None


class Bundle:
    """Writes frames to an open file and notes the seek table."""

    def __init__(self, sink):
        import zstandard

        self.sink, self.at, self.table = sink, 0, []
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def frame(self, data: bytes) -> tuple[int, int, int]:
        """Number, place and size of the new frame."""
        packed = self.compressor.compress(data)
        self.sink.write(packed)
        place, self.at = self.at, self.at + len(packed)
        self.table.append((len(packed), len(data)))
        return len(self.table) - 1, place, len(packed)

    def close(self) -> None:
        body = b"".join(struct.pack("<II", *x) for x in self.table) + struct.pack("<IBI", len(self.table), 0, _SEEKABLE)
        self.sink.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)
        self.sink.close()


def seek_table(source, size: int) -> list[tuple[int, int, int]]:
    """(place, packed size, size) of the frames of a bundle, from its end."""
    source.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    source.seek(size - 9 - 8 * n)
    sizes = np.frombuffer(source.read(8 * n), "<u4").reshape(n, 2).astype(np.int64)
    places = np.cumsum(sizes[:, 0]) - sizes[:, 0]
    return list(zip(places.tolist(), sizes[:, 0].tolist(), sizes[:, 1].tolist(), strict=True))


def _write(batches: Iterator[pd.DataFrame], folder: str, frame_bytes: int) -> Iterator[pd.DataFrame]:
    files, base = filesystem(folder)
    task = TaskContext.get()
    # Attempts of a task write files of their own; the index names those of the one that counts.
    name = f"part-{task.partitionId() if task else 0:05d}-{uuid.uuid4().hex[:8]}.warc.zst"
    bundle, held, noted = None, [], []

    def flush() -> pd.DataFrame:
        nonlocal held, noted
        number, place, size = bundle.frame(b"".join(held))
        out = pd.DataFrame(noted, columns=["page_id", "record_offset", "record_bytes"])
        out["page_id"] = out["page_id"].astype("Int64")
        held, noted = [], []
        return out.assign(bundle=f"{folder}/{name}", frame=number, frame_place=place, frame_bytes=size)

    at = 0
    for pdf in batches:
        for page_id, url, payload, length, digest, first in zip(pdf["page_id"], pdf["url"], pdf["payload"], pdf["length"], pdf["digest"], pdf["first_id"], strict=True):
            if bundle is None:
                files.create_dir(base, recursive=True)
                bundle = Bundle(files.open_output_stream(f"{base}/{name}", compression=None))
            page_id, first = (None if pd.isna(x) else int(x) for x in (page_id, first))
            data = record(page_id, url, bytes(payload or b""), int(length), base32(bytes(digest)), None if first is None or first == page_id else first)
            noted.append((page_id, at, len(data)))
            held.append(data)
            at += len(data)
            if at >= frame_bytes:
                yield flush()
                at = 0
    if noted:
        yield flush()
    if bundle:
        bundle.close()


def write(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Writes bundles to a folder that executors share; the index: page_id, bundle, frame, frame_place, frame_bytes, record_offset, record_bytes.

    Ids are whole numbers, or text that holds them. Of rows with equal payloads (null: empty) that with the smallest page_id is a response, and so are rows that repeat
    this id; others revisit it. A null page_id among payloads without any id is a response. Payloads of any length are
    written whole. What is found by digest are pairs of page and digest, without payloads, and minima are combined before
    they are shuffled; rows meet the answers by page and digest, so that many equal payloads are spread over tasks."""
    ship_package(pages.sparkSession)
    data = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), data.alias("payload"), F.unhex(F.sha1(data)).alias("digest"))
    pairs = as_table(as_table(rows.select("page_id", "digest"), "digests").distinct(), "pairs")
    firsts = as_table(pairs.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("pages")), "firsts")
    # Payloads of many pages are HOT_PAYLOADS at most, so they go to where the pages lie; no other has a task to itself.
    least = max(HOT_PAGES, pairs.count() // HOT_PAYLOADS)
    hot = F.broadcast(firsts.where(F.col("pages") > least).select("digest", "first_id"))
    rest = pairs.join(hot.select("digest"), "digest", "left_anti").join(firsts.where(F.col("pages") <= least).select("digest", "first_id"), "digest")
    answers = pairs.join(hot, "digest").unionByName(rest).select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "first_id")
    met = rows.join(answers, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))).drop("_page", "_digest")
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    met = met.select("page_id", "url", "digest", "first_id", F.octet_length("payload").cast("long").alias("length"), F.when(~revisit, F.col("payload")).alias("payload"))
    schema = "page_id long, record_offset long, record_bytes long, bundle string, frame long, frame_place long, frame_bytes long"
    return as_table(met.mapInPandas(lambda batches: _write(batches, folder, frame_bytes), schema), "index")


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[dict[str, str], bytes, int, bytes]]:
    """Headers, HTTP header's payload length and payload of the records that index rows name; a frame is unpacked once in a row."""
    import zstandard

    unpack, opened, frames, here, data = zstandard.ZstdDecompressor(), None, [], None, b""
    for pdf in batches:
        for path, frame, offset, size in zip(pdf["bundle"], pdf["frame"], pdf["record_offset"], pdf["record_bytes"], strict=True):
            if (path, frame) != here:
                if not here or here[0] != path:
                    files, inner = filesystem(path)
                    opened = files.open_input_file(inner)
                    frames = seek_table(opened, opened.size())
                place, packed, whole = frames[frame]
                opened.seek(place)
                data, here = unpack.decompress(opened.read(packed), max_output_size=whole), (path, frame)
            headers, block, end = parse(data, offset)
            if end != offset + size:
                raise ValueError("the record has another length than the index says")
            http, _, payload = block.partition(b"\r\n\r\n")
            length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            said = headers["warc-payload-digest"].removeprefix("sha1:")
            if headers["warc-type"] == "response" and (length != len(payload) or base32(hashlib.sha1(payload).digest()) != said):
                raise ValueError("the payload is not the one that was written")
            yield headers, said, length, payload


def _typed(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.astype({c: "Int64" for c in ("page_id", "refers_to", "payload_bytes") if c in names})


def _read(batches: Iterator[pd.DataFrame], with_payload: bool) -> Iterator[pd.DataFrame]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * with_payload]
    rows = []
    for headers, said, length, payload in _records(batches):
        own = [payload if headers["warc-type"] == "response" else None] if with_payload else []
        rows.append((_page(headers["warc-record-id"]), length, said, headers["warc-type"], _page(headers.get("warc-refers-to")), *own))
        if len(rows) >= (200 if with_payload else 5000):
            yield _typed(rows, names)
            rows = []
    yield _typed(rows, names)


def read(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records of an index, read from their bundles;
    with_payload adds the payload, null for revisits.

    Payloads of responses are digested again and checked. The index is read in its own order, frame after frame."""
    ship_package(index.sparkSession)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    return index.select("bundle", "frame", "record_offset", "record_bytes").mapInPandas(lambda batches: _read(batches, with_payload), schema)


def lookup(index: DataFrame, page_id: int) -> DataFrame:
    """The records of one page, each by one read of a seek table and of one frame; the index's rows of other pages are not read from bundles."""
    return read(index.where(F.col("page_id") == page_id), with_payload=True)


def archive(pages: DataFrame, frame_bytes: int = FRAME_BYTES, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Writes all pages to bundles in the shared folder and reads them back; an empty table gives an empty result.

    Ids are whole numbers. Null payloads are empty ones; a null url has no target; repeated rows keep a record each; other columns are ignored."""
    return read(write(pages, fresh_path(pages.sparkSession, "warc"), frame_bytes, page_id, url, payload))
