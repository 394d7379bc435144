"""Media columns of progressive JPEG.

decode() reads progressive JPEG: it accumulates spectral-selection and successive-approximation scans into coefficient
arrays, inverse-transforms them in numpy, upsamples the chroma and returns a full-resolution RGB tensor. Scans whose
symbols all are alike, as those of encode() are, and runs of finished blocks in refining scans are read by whole arrays;
other scans, so those of other encoders, symbol by symbol and bit by bit, which is slow.

encode() stores bytes losslessly in the unit of the format, the quantized coefficient: a byte b is the coefficient b if
b >= 128, else b - 255, so that every coefficient has 8 magnitude bits and these bits are the byte. 63 of the 64
coefficients of a block hold bytes, in zigzag order, Y blocks first, then Cb, then Cr; the DC coefficient is 0.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_table, ship_package

UNIT = 576  # payloads are filled up with bytes 255 to a multiple of this
_SPLIT = (1, 6, 64)  # spectral bands of the first scans
_MARK = b"fieldweave payload "


def _zigzag() -> np.ndarray:
    """The natural place of each coefficient in zigzag order: along the diagonals, turning at each."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([8 * r + c for r, c in cells])


ZIGZAG = _zigzag()


def _basis() -> np.ndarray:
    """[zigzag coefficient, pixel] of the inverse transform in units of 2 ** -13, as whole numbers: sums are exact, in any order."""
    x = np.arange(8)
    one = np.where(x == 0, np.sqrt(0.5), 1.0)[:, None] * np.cos((2 * x[None, :] + 1) * x[:, None] * np.pi / 16) / 2
    both = np.einsum("uy,vx->uvyx", one, one).reshape(64, 64)
    return np.rint(both[ZIGZAG] * 8192)


BASIS = _basis()


# ---------------------------------------------------------------- encoding


def pad(text: str | None) -> tuple[bytes, int]:
    """The payload of a text and its length before padding."""
    data = (text or "").encode()
    return data + b"\xff" * (-len(data) % UNIT if data else UNIT), len(data)


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def _table(kind: int, slot: int, codes: list[tuple[int, list[int]]]) -> bytes:
    """A DHT body: symbols by code length."""
    by = dict(codes)
    return bytes([kind << 4 | slot]) + bytes(len(by.get(n, [])) for n in range(1, 17)) + bytes(s for n in range(1, 17) for s in by.get(n, []))


def _pack(bits: np.ndarray) -> bytes:
    """Bits, filled up with ones, with a zero byte after each byte 255."""
    return np.packbits(np.concatenate([bits, np.ones(-len(bits) % 8, np.uint8)])).tobytes().replace(b"\xff", b"\xff\x00")


def _number(n: int, width: int) -> list[int]:
    return [n >> (width - 1 - i) & 1 for i in range(width)]


def encode(payload: bytes) -> bytes:
    """A 4:2:0 progressive JPEG that holds the payload in its coefficients."""
    blocks = max(1, -(-len(payload) // 63))
    units = -(-blocks // 6)  # of 4 Y, 1 Cb and 1 Cr block
    across = -(-units // 4095)
    down = -(-units // across)
    units = across * down
    data = np.frombuffer(payload.ljust(units * 6 * 63, b"\xff"), np.uint8).reshape(-1, 63)
    parts = (data[: 4 * units], data[4 * units : 5 * units], data[5 * units :])
    runs = [0x10 * r for r in range(15)]  # end-of-band symbols
    out = [b"\xff\xd8", _segment(0xFE, _MARK + str(len(payload)).encode()), _segment(0xDB, bytes([0]) + bytes([1] * 64))]
    out.append(_segment(0xC2, bytes([8]) + (16 * down).to_bytes(2, "big") + (16 * across).to_bytes(2, "big") + bytes([3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])))
    out.append(_segment(0xC4, _table(0, 0, [(1, [0])]) + _table(1, 0, [(1, [7]), (5, runs)])))
    # DC, all components: the difference is 0 in every block.
    out += [_segment(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 0, 0x01])), _pack(np.zeros(6 * units, np.uint8))]
    for component, part in enumerate(parts, 1):
        for low, high in zip(_SPLIT, _SPLIT[1:], strict=False):
            # Symbol (0 zeros, 7 bits), a 0, and the 7 upper bits of the byte: a byte below 128, never 255.
            out += [_segment(0xDA, bytes([1, component, 0, low, high - 1, 0x01])), (part[:, low - 1 : high - 1] >> 1).tobytes()]
    for component, part in enumerate(parts, 1):
        bits, low = [], np.where(part >= 128, part & 1, ~part & 1).astype(np.uint8)
        for at in range(0, len(low), 32767):
            some = low[at : at + 32767]
            width = len(some).bit_length() - 1
            bits += [_end_of_band(width, len(some)), some.ravel()]
        out += [_segment(0xDA, bytes([1, component, 0, 1, 63, 0x10])), _pack(np.concatenate(bits))]
    return b"".join([*out, b"\xff\xd9"])


def _end_of_band(width: int, blocks: int) -> np.ndarray:
    """The code of symbol 0x10 * width, the 15 of which follow the one-bit code 0 as 10000, 10001 and so on, and its bits."""
    return np.array(_number(16 + width, 5) + _number(blocks - (1 << width), width), np.uint8)


# ---------------------------------------------------------------- decoding


class _Bits:
    """Bits of a scan segment with its stuffing removed; beyond the end there are ones."""

    def __init__(self, data: bytes):
        self.bits = np.unpackbits(np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8))
        self.at = 0

    def read(self, n: int) -> int:
        out = 0
        for _ in range(n):
            out = out << 1 | (int(self.bits[self.at]) if self.at < len(self.bits) else 1)
            self.at += 1
        return out

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.read(1)
            if (n, code) in table:
                return table[n, code]
        raise ValueError("no such code")

    def signed(self, n: int) -> int:
        x = self.read(n)
        return x if n == 0 or x >> (n - 1) else x - (1 << n) + 1


class _Component:
    def __init__(self, name: int, h: int, v: int, table: int):
        self.name, self.h, self.v, self.table = name, h, v, table
        self.across = self.down = self.wide = 0
        self.blocks = np.zeros((0, 64), np.int32)


def _huffman(body: bytes, tables: dict[int, dict[tuple[int, int], int]]) -> None:
    while body:
        counts, at, code, table = body[1:17], 17, 0, {}
        for n, count in enumerate(counts, 1):
            for _ in range(count):
                table[n, code] = body[at]
                at, code = at + 1, code + 1
            code <<= 1
        tables[body[0]] = table
        body = body[at:]


def _scan_order(parts: list[_Component], units: int, across: int) -> Iterator[tuple[_Component, int]]:
    """Blocks in the order of a scan: its own blocks if it is of one component, else those of unit after unit."""
    if len(parts) == 1:
        p = parts[0]
        for i in range(p.across * p.down):
            yield p, i // p.across * p.wide + i % p.across
        return
    for unit in range(units):
        y, x = divmod(unit, across)
        for p in parts:
            for v in range(p.v):
                for h in range(p.h):
                    yield p, (y * p.v + v) * p.wide + x * p.h + h


def _alike(bits: _Bits, table: dict, n: int) -> np.ndarray | None:
    """The values of n coefficients if every symbol of the scan is the same one without zeros before it, else None."""
    if n == 0 or len(bits.bits) == 0:
        return None
    for (length, code), symbol in table.items():
        size = symbol & 15
        if symbol >> 4 or not size or len(bits.bits) < n * (length + size):
            continue
        rows = bits.bits[: n * (length + size)].reshape(n, length + size)
        if (rows[:, :length] == np.array(_number(code, length), np.uint8)).all():
            value = rows[:, length:].astype(np.int32) @ (1 << np.arange(size - 1, -1, -1, dtype=np.int32))
            return np.where(rows[:, length] == 1, value, value - (1 << size) + 1)
    return None


def _scan(parts: list[_Component], tables: dict, which: list[int], band: tuple[int, int], high: int, low: int, segments: list[bytes], interval: int, units: int, across: int, quick: bool) -> None:
    order = list(_scan_order(parts, units, across)) if not (quick and len(parts) == 1) else None
    per_unit = sum(p.h * p.v for p in parts) if len(parts) > 1 else 1
    total = len(order) if order is not None else parts[0].across * parts[0].down
    step = interval * per_unit if interval else total
    for number, segment in enumerate(segments):
        bits = _Bits(segment)
        a, b = number * step, min(total, (number + 1) * step)
        if band[0] == 0:
            if quick and not high and all(tables[0][w].get((1, 0)) == 0 for w in which) and not bits.bits[: b - a].any() and len(bits.bits) >= b - a:
                continue  # every difference is 0
            before: dict[int, int] = {}
            for p, i in order if order is not None and (a, b) == (0, total) else list(_scan_order(parts, units, across))[a:b]:
                if high:
                    p.blocks[i, 0] |= bits.read(1) << low
                else:
                    before[p.name] = before.get(p.name, 0) + bits.signed(bits.symbol(tables[0][which[parts.index(p)]]))
                    p.blocks[i, 0] = before[p.name] << low
            continue
        p, table, (first, last) = parts[0], tables[1][which[0]], band
        mine = np.arange(a, b)
        mine = mine // p.across * p.wide + mine % p.across
        if quick and not high and (values := _alike(bits, table, (b - a) * (last - first + 1))) is not None:
            p.blocks[mine, first : last + 1] = (values << low).reshape(b - a, -1) if low == 0 else (np.sign(values) * (np.abs(values) << low)).reshape(b - a, -1)
            continue
        (_refine if high else _first)(bits, table, p.blocks, mine.tolist(), first, last, low, quick)


def _first(bits: _Bits, table: dict, blocks: np.ndarray, mine: list[int], first: int, last: int, low: int, quick: bool) -> None:
    run = 0
    for i in mine:
        if run:
            run -= 1
            continue
        k = first
        while k <= last:
            zeros, size = divmod(bits.symbol(table), 16)
            if size:
                k += zeros
                value = bits.signed(size)
                blocks[i, k] = (abs(value) << low) * (1 if value > 0 else -1)
                k += 1
            elif zeros == 15:
                k += 16
            else:
                run = (1 << zeros) + bits.read(zeros) - 1
                break


def _refine(bits: _Bits, table: dict, blocks: np.ndarray, mine: list[int], first: int, last: int, low: int, quick: bool) -> None:
    def correct(rows, k: int) -> None:
        """One bit for each coefficient from k on that is not 0."""
        part = blocks[rows, k : last + 1]
        flat = np.flatnonzero(part)
        more = bits.bits[bits.at : bits.at + len(flat)].astype(np.int32)
        more = np.concatenate([more, np.ones(len(flat) - len(more), np.int32)])
        bits.at += len(flat)
        values = part.ravel()
        values[flat] += np.sign(values[flat]) * (more << low)
        blocks[rows, k : last + 1] = values.reshape(part.shape)

    at = 0
    while at < len(mine):
        i, k, run = mine[at], first, 0
        while k <= last:
            zeros, size = divmod(bits.symbol(table), 16)
            if size == 0 and zeros < 15:
                run = (1 << zeros) + bits.read(zeros)
                break
            value = bits.signed(1) if size else 0
            while k <= last:
                if blocks[i, k]:
                    if bits.read(1):
                        blocks[i, k] += (1 << low) * (1 if blocks[i, k] > 0 else -1)
                elif zeros == 0:
                    if value:
                        blocks[i, k] = (1 << low) * (1 if value > 0 else -1)
                    k += 1
                    break
                else:
                    zeros -= 1
                k += 1
        if not run:
            at += 1
            continue
        correct([i], k)
        rest = mine[at + 1 : at + run]
        if rest:
            correct(np.array(rest), first)
        at += run


def coefficients(data: bytes, quick: bool = True) -> tuple[int, int, list[_Component], dict[int, np.ndarray], list[bytes]]:
    """Height, width, components with their coefficient arrays (zigzag order), quantization tables, comments."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    at, parts, quant, tables, comments, interval = 2, [], {}, ({}, {}), [], 0
    height = width = units = across = 0
    while at < len(data):
        marker = data[at + 1]
        if marker == 0xD9:
            break
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            found: dict = {}
            _huffman(body, found)
            for key, table in found.items():
                tables[key >> 4][key & 15] = table
        elif marker == 0xDD:
            interval = int.from_bytes(body, "big")
        elif marker == 0xFE:
            comments.append(body)
        elif marker == 0xC2:
            height, width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            parts = [_Component(body[i], body[i + 1] >> 4, body[i + 1] & 15, body[i + 2]) for i in range(6, 6 + 3 * body[5], 3)]
            h, v = max(p.h for p in parts), max(p.v for p in parts)
            across, down = -(-width // (8 * h)), -(-height // (8 * v))
            units = across * down
            for p in parts:
                p.across, p.down, p.wide = -(-width * p.h // (8 * h)), -(-height * p.v // (8 * v)), across * p.h
                p.blocks = np.zeros((across * p.h * down * p.v, 64), np.int32)
        elif 0xC0 <= marker <= 0xCF:
            raise ValueError("not a progressive JPEG")
        elif marker == 0xDA:
            n = body[0]
            names, which = [body[1 + 2 * i] for i in range(n)], [body[2 + 2 * i] for i in range(n)]
            first, last, approx = body[1 + 2 * n : 4 + 2 * n]
            segments, start = [], at
            while True:  # entropy-coded data ends at a marker that is neither stuffing nor a restart
                at = data.find(b"\xff", at)
                if at < 0:
                    at = len(data)
                    break
                if data[at + 1] == 0:
                    at += 2
                elif 0xD0 <= data[at + 1] <= 0xD7:
                    segments.append(data[start:at])
                    at = start = at + 2
                else:
                    break
            segments.append(data[start:at])
            chosen = [next(p for p in parts if p.name == name) for name in names]
            slot = [w >> 4 if first == 0 else w & 15 for w in which]
            _scan(chosen, tables, slot, (first, last), approx >> 4, approx & 15, segments, interval, units, across, quick)
    return height, width, parts, quant, comments


def _plane(p: _Component, quant: np.ndarray) -> np.ndarray:
    """Samples of a component, before clipping is applied to its upsampled form."""
    rows = []
    for a in range(0, len(p.blocks), 8192):
        exact = (p.blocks[a : a + 8192] * quant).astype(np.float64) @ BASIS
        rows.append(np.clip((exact.astype(np.int64) + 4096 >> 13) + 128, 0, 255).astype(np.int32))
    pixels = np.concatenate(rows).reshape(-1, p.wide, 8, 8)
    return pixels.transpose(0, 2, 1, 3).reshape(-1, p.wide * 8)


def tensor(height: int, width: int, parts: list[_Component], quant: dict[int, np.ndarray]) -> np.ndarray:
    """[height, width, 3] uint8 RGB."""
    h, v = max(p.h for p in parts), max(p.v for p in parts)
    planes = [np.repeat(np.repeat(_plane(p, quant[p.table]), v // p.v, axis=0), h // p.h, axis=1)[:height, :width] for p in parts]
    if len(planes) == 1:
        return np.repeat(planes[0][:, :, None], 3, axis=2).astype(np.uint8)
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    half = 1 << 15  # the colour matrix in units of 2 ** -16
    out = np.stack([y + (91881 * cr + half >> 16), y - (22554 * cb + 46802 * cr + half >> 16), y + (116130 * cb + half >> 16)], axis=2)
    return np.clip(out, 0, 255).astype(np.uint8)


def decode(data: bytes) -> np.ndarray:
    """[height, width, 3] uint8 RGB of a progressive JPEG."""
    height, width, parts, quant, _ = coefficients(data)
    return tensor(height, width, parts, quant)


def payload_of(parts: list[_Component], comments: list[bytes]) -> bytes:
    """The bytes that encode() has stored."""
    size = next((int(c[len(_MARK) :]) for c in comments if c.startswith(_MARK)), None)
    if size is None:
        raise ValueError("it holds no payload")
    values = np.concatenate([p.blocks[:, 1:] for p in parts]).ravel()[:size]
    return np.where(values > 0, values, values + 255).astype(np.uint8).tobytes()


# ---------------------------------------------------------------- columns


def _encoded(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in parts:
        made = [pad(t) for t in texts]
        yield pd.DataFrame({"n_bytes": np.array([n for _, n in made], np.int64), "media": [encode(p) for p, _ in made]})


def media(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each text (null: empty) as a progressive JPEG that holds its bytes."""
    ship_package(docs.sparkSession)
    encoded = F.pandas_udf(_encoded, "n_bytes long, media binary").asNondeterministic()  # evaluated once, however often its result is used
    return docs.select(F.col(doc_id).alias("doc_id"), encoded(F.col(text)).alias("made")).select("doc_id", "made.n_bytes", "made.media")


def stored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """media() written as a table in the shared folder and read again."""
    return as_table(media(docs, doc_id, text), "media", compression="zstd")


def tensors(rows: DataFrame, column: str = "media") -> DataFrame:
    """The rows with height, width and rgb (row-major bytes) of a column of progressive JPEG; null where that is null."""
    ship_package(rows.sparkSession)

    @F.pandas_udf("height int, width int, rgb binary")
    def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for some in parts:
            found = [None if d is None else decode(bytes(d)) for d in some]
            yield pd.DataFrame({"height": pd.array([None if x is None else x.shape[0] for x in found], "Int32"), "width": pd.array([None if x is None else x.shape[1] for x in found], "Int32"), "rgb": [None if x is None else x.tobytes() for x in found]})

    return rows.withColumn("_tensor", decoded.asNondeterministic()(F.col(column))).select(*rows.columns, "_tensor.height", "_tensor.width", "_tensor.rgb")


def _features(data: bytes) -> tuple:
    height, width, parts, quant, comments = coefficients(data)
    payload, rgb = payload_of(parts, comments), tensor(height, width, parts, quant)
    sums = rgb.reshape(-1, 3).sum(axis=0, dtype=np.int64)
    feature = f"{height}x{width} {'/'.join(str(s) for s in sums)} {zlib.crc32(rgb):08x}"
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature


def _digests(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    for some in parts:
        yield pd.DataFrame([_features(bytes(d)) for d in some], columns=names)


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_bytes and what reading the media column of media() gives: the payload, the stored form and a feature of the RGB tensor.

    The feature is height x width, the sums of the three channels and the CRC-32 of the tensor. Null and empty texts have
    a payload of 576 bytes 255; a text of any length is one image; equal texts have equal values; repeated rows keep a row each; an empty table gives an
    empty result; other columns are ignored."""
    read = F.pandas_udf(_digests, "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string").asNondeterministic()
    return rows.select("doc_id", "n_bytes", read(F.col("media")).alias("d")).select("doc_id", "n_bytes", "d.*")
