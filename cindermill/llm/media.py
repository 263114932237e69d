"""Media columns: Netpbm and BMP files in a binary column, decoded to numpy arrays.

Arrays are resized by area: the value of a target cell is the exact mean of the source area that it
covers, taken from the integral image, which is evaluated at the rows that are needed only, so an
image of any height takes little memory. Thumbnails are written as NPY tiles; the difference hash
compares horizontal neighbours of a 9 x 8 area-resized image.

Defined cases: bytes that are no readable image, or null, give null columns; an image of one row or
one column is resized like any other; equal bytes give equal values.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import materialise

_TOKEN = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])*([^\s#]+)")


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 as an array of rows x columns, or rows x columns x 3; bitmaps have 0 for black and 1 for white."""
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not a Netpbm file")
    at, fields = 2, []
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        found = _TOKEN.match(data, at)
        if not found:
            raise ValueError("the header ends early")
        fields.append(int(found[1]))
        at = found.end()
    width, height = fields[:2]
    depth = 3 if kind in (b"P3", b"P6") else 1
    count = width * height * depth
    if kind in (b"P4", b"P5", b"P6"):
        at += 1  # one white space ends the header
        if kind == b"P4":
            stride = (width + 7) // 8
            rows = np.frombuffer(data, np.uint8, stride * height, at).reshape(height, stride)
            return 1 - np.unpackbits(rows, axis=1)[:, :width]
        values = np.frombuffer(data, np.uint8 if fields[2] < 256 else ">u2", count, at)
    elif kind == b"P1":
        body = re.sub(rb"#[^\n\r]*|\s", b"", data[at:])
        values = 1 - (np.frombuffer(body, np.uint8, count) - ord("0"))
    else:
        body = re.sub(rb"#[^\n\r]*", b"", data[at:]).split()
        values = np.array(body[:count], dtype=np.int64).astype(np.uint8 if fields[2] < 256 else np.uint16)
    return values.reshape((height, width, 3) if depth == 3 else (height, width))


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 24 or 32 bits as rows x columns x 3; palettes are applied, and grey ones give rows x columns."""
    if data[:2] != b"BM":
        raise ValueError("not a BMP file")
    pixels, header = struct.unpack_from("<II", data, 10)
    width, height, _, bits, packing = struct.unpack_from("<iiHHI", data, 18)
    if packing or bits not in (1, 4, 8, 24, 32):
        raise ValueError("this kind of BMP is not supported")
    upright, height = height < 0, abs(height)
    stride = (width * bits + 31) // 32 * 4
    rows = np.frombuffer(data, np.uint8, stride * height, pixels).reshape(height, stride)
    rows = rows if upright else rows[::-1]
    if bits >= 24:
        return rows[:, :width * bits // 8].reshape(height, width, bits // 8)[:, :, 2::-1]
    if bits == 8:
        index = rows[:, :width]
    elif bits == 4:
        index = np.stack([rows >> 4, rows & 15], axis=2).reshape(height, -1)[:, :width]
    else:
        index = np.unpackbits(rows, axis=1)[:, :width]
    colours = struct.unpack_from("<I", data, 46)[0] or 1 << bits
    palette = np.frombuffer(data, np.uint8, 4 * colours, 14 + header).reshape(-1, 4)[:, 2::-1]
    grey = (palette == palette[:, :1]).all()
    return palette[index][:, :, 0] if grey else palette[index]


def decode_image(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def encode_pgm(samples: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (samples.shape[1], samples.shape[0]) + samples.tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """An 8-bit grey BMP, bottom row first."""
    height, width = samples.shape
    stride = (width + 3) // 4 * 4
    rows = np.zeros((height, stride), dtype=np.uint8)
    rows[:, :width] = samples[::-1]
    palette = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 4, axis=1)
    palette[:, 3] = 0
    begin = 14 + 40 + palette.nbytes
    return struct.pack("<2sIHHI", b"BM", begin + rows.nbytes, 0, 0, begin) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8, 0, rows.nbytes, 2835, 2835, 256, 0) + palette.tobytes() + rows.tobytes()


def integral_image(image: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The integral image at the given rows: sums over all that lies above a row and left of a column.

    `rows` are whole, rising and start with 0. Only they are kept, so an image of any height takes little memory.
    """
    kind = np.float64 if image.dtype.kind == "f" else np.int64
    strips = np.add.reduceat(image, rows[:-1], axis=0, dtype=kind) if len(rows) > 1 else np.zeros((0, *image.shape[1:]), dtype=kind)
    table = np.zeros((len(rows), image.shape[1] + 1, *image.shape[2:]), dtype=kind)
    table[1:, 1:] = strips.cumsum(axis=0).cumsum(axis=1)
    return table


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over the source areas of a height x width grid, each from the four corners of its area in the integral image.

    Between whole places the integral image is bilinear, since samples are constant within their cells.
    """
    if not image.size:
        raise ValueError("an image without samples")
    ys, xs = np.linspace(0, image.shape[0], height + 1), np.linspace(0, image.shape[1], width + 1)
    y0, x0 = np.minimum(ys.astype(np.int64), image.shape[0] - 1), np.minimum(xs.astype(np.int64), image.shape[1] - 1)
    needed = np.unique(np.r_[0, y0, y0 + 1])
    table = integral_image(image, needed)
    grey = [1] * (image.ndim - 2)
    dy, dx = (ys - y0).reshape(-1, 1, *grey), (xs - x0).reshape(1, -1, *grey)
    above, below = np.searchsorted(needed, y0), np.searchsorted(needed, y0 + 1)
    at = lambda r, c: table[r][:, c]
    corners = (1 - dy) * ((1 - dx) * at(above, x0) + dx * at(above, x0 + 1)) + dy * ((1 - dx) * at(below, x0) + dx * at(below, x0 + 1))
    sums = corners[1:, 1:] - corners[:-1, 1:] - corners[1:, :-1] + corners[:-1, :-1]
    return sums / (image.shape[0] / height * (image.shape[1] / width))


def difference_hash(image: np.ndarray) -> str:
    """64 bits, one for each neighbour to the right that is brighter, as 16 hex digits."""
    grey = image.mean(axis=2) if image.ndim == 3 else image
    small = area_resize(grey, 8, 9)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(array), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def tiles(df: DataFrame, key: str, media: str, height: int = 64, width: int = 64, tile: int = 32) -> DataFrame:
    """NPY tiles of each image in a binary column after area-resizing to height x width.

    One row per tile: key, tile_row, tile_column, npy, and the image's difference hash.
    """

    parts = [(y, x) for y in range(0, height, tile) for x in range(0, width, tile)]

    def cut(data: bytes | None) -> list[tuple]:
        try:
            image = decode_image(data or b"")
            small, mark = np.rint(area_resize(image, height, width)).astype(np.uint8), difference_hash(image)
        except (ValueError, OverflowError, IndexError, ZeroDivisionError, MemoryError, struct.error):
            return [(None, None, None, None)]
        return [(y // tile, x // tile, npy(small[y:y + tile, x:x + tile]), mark) for y, x in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.string())
        for batch in batches:
            for begin in range(0, len(batch), 256):
                rows = [(begin + at, *made) for at, value in enumerate(batch.column(1).slice(begin, 256)) for made in cut(value.as_py())]
                source, *columns = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(source)), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=[key, "tile_row", "tile_column", "npy", "difference_hash"])

    return df.select(key, media).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, tile_row int, tile_column int, npy binary, difference_hash string")


def stored_as_images(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 64) -> DataFrame:
    """Texts as PGM files: UTF-8 bytes, padded with 0 to a positive multiple of the width, one sample a byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):  # in small batches: the texts are whole
                part, files, sizes = batch.slice(at, 256), [], []
                for value in part.column(1):
                    data = value.as_py() or b""
                    padded = data.ljust(max(1, -(-len(data) // width)) * width, b"\0")
                    files.append(encode_pgm(np.frombuffer(padded, np.uint8).reshape(-1, width)))
                    sizes.append(len(data))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], names=[key, "n_bytes", "media"])

    return df.select(key, F.col(text).cast("binary")).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, n_bytes long, media binary")


def digests(stored: DataFrame, key: str = "doc_id", tile: int = 16) -> DataFrame:
    """Read images back and describe them: payload, file, difference hash and the NPY tile of the thumbnail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for value in batch.column(2):
                data = value.as_py()
                image = decode_image(data)
                payload = image.tobytes()
                thumbnail = npy(np.rint(area_resize(image, tile, tile)).astype(np.uint8))
                made.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), difference_hash(image), thumbnail))
            columns = list(zip(*made)) or [()] * 7
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(c, t) for c, t in zip(columns, kinds))], names=[key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "npy_tile"])

    return stored.select(key, "n_bytes", "media").mapInArrow(run, f"`{key}` {stored.schema[key].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, npy_tile binary")


def media_columns(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 64) -> DataFrame:
    """Store every text as an image in the shared folder, read the files back and describe them."""
    return digests(materialise(stored_as_images(df, key, text, width)), key)
