"""GeoTIFF rasters as tables of pixels: a Python data source with tasks for ranges of strips or tiles.

Only the header is read on the driver; a task reads the bytes of its own strips.  One band, classic and big
TIFF, plain or deflated, with or without the horizontal predictor.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import ranges

SCHEMA = "row int, col int, value double, tie_x double, tie_y double, scale_x double, scale_y double, nodata double"

# Tags of the format and its codes.
WIDTH, LENGTH, BITS, COMPRESSION, STRIP_OFFSETS, SAMPLES, STRIP_ROWS, STRIP_BYTES = 256, 257, 258, 259, 273, 277, 278, 279
PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_BYTES, SAMPLE_FORMAT = 317, 322, 323, 324, 325, 339
PIXEL_SCALE, TIEPOINT, NODATA = 33550, 33922, 42113
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
PLAIN, DEFLATE, DEFLATE_OLD = 1, 8, 32946
KINDS = {1: "u", 2: "i", 3: "f"}


@dataclass(frozen=True)
class Header:
    """What a raster's header says; chunks are strips or tiles as (first row, first column, offset, bytes)."""

    width: int
    length: int
    chunk_width: int
    chunk_length: int
    chunks: tuple[tuple[int, int, int, int], ...]
    dtype: str
    compression: int
    predictor: int
    tie: tuple[float, float]
    scale: tuple[float, float]
    nodata: float | None


def _tags(path: str) -> tuple[str, dict[int, tuple]]:
    head = ranges.read(path, 0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    magic = struct.unpack(f"{order}H", head[2:4])[0] if order else 0
    if magic not in (42, 43):
        raise ValueError(f"{path} is no TIFF")
    big = magic == 43
    at = struct.unpack(f"{order}Q", head[8:16])[0] if big else struct.unpack(f"{order}I", head[4:8])[0]
    count_size, entry_size, inline = (8, 20, 8) if big else (2, 12, 4)
    n = struct.unpack(f"{order}{'Q' if big else 'H'}", ranges.read(path, at, count_size))[0]
    entries = ranges.read(path, at + count_size, n * entry_size)
    tags = {}
    for i in range(n):
        entry = entries[i * entry_size : (i + 1) * entry_size]
        tag, kind = struct.unpack(f"{order}HH", entry[:4])
        count = struct.unpack(f"{order}{'Q' if big else 'I'}", entry[4 : entry_size - inline])[0]
        code = TYPES.get(kind)
        if code is None:
            continue
        form = f"{order}{count}s" if code == "s" else f"{order}{count * len(code)}{code[0]}"
        raw = entry[entry_size - inline :]
        if struct.calcsize(form) > inline:
            raw = ranges.read(path, struct.unpack(f"{order}{'Q' if big else 'I'}", raw)[0], struct.calcsize(form))
        tags[tag] = struct.unpack(form, raw[: struct.calcsize(form)])
    return order, tags


def read_header(path: str) -> Header:
    """Header of a raster; a missing tag, more than one band or another compression is an error."""
    order, tags = _tags(path)
    one = lambda tag, default=None: tags[tag][0] if tag in tags else default
    missing = [name for name, tag in (("width", WIDTH), ("length", LENGTH), ("pixel scale", PIXEL_SCALE), ("tie point", TIEPOINT)) if tag not in tags]
    if missing:
        raise ValueError(f"{path} has no {' and no '.join(missing)}")
    if one(SAMPLES, 1) != 1:
        raise ValueError(f"{path} has {one(SAMPLES)} bands")
    if one(COMPRESSION, PLAIN) not in (PLAIN, DEFLATE, DEFLATE_OLD):
        raise ValueError(f"{path} has compression {one(COMPRESSION)}; plain and deflate are read")
    if one(PREDICTOR, 1) not in (1, 2):
        raise ValueError(f"{path} has predictor {one(PREDICTOR)}; 1 and 2 are read")
    width, length = one(WIDTH), one(LENGTH)
    tiled = TILE_OFFSETS in tags
    chunk_width, chunk_length = (one(TILE_WIDTH), one(TILE_LENGTH)) if tiled else (width, min(length, one(STRIP_ROWS, length)))
    offsets, sizes = (tags[TILE_OFFSETS], tags[TILE_BYTES]) if tiled else (tags.get(STRIP_OFFSETS, ()), tags.get(STRIP_BYTES, ()))
    across = -(-width // chunk_width)
    if len(offsets) != across * -(-length // chunk_length) or len(sizes) != len(offsets):
        raise ValueError(f"{path} has {len(offsets)} strips or tiles, not those of its size")
    chunks = tuple((i // across * chunk_length, i % across * chunk_width, o, s) for i, (o, s) in enumerate(zip(offsets, sizes, strict=True)))
    nodata = tags[NODATA][0].split(b"\0")[0].strip() if NODATA in tags else b""
    return Header(
        width, length, chunk_width, chunk_length, chunks, f"{order}{KINDS[one(SAMPLE_FORMAT, 1)]}{one(BITS, 1) // 8}", one(COMPRESSION, PLAIN), one(PREDICTOR, 1),
        tuple(map(float, tags[TIEPOINT][3:5])), tuple(map(float, tags[PIXEL_SCALE][:2])), float(nodata) if nodata else None,
    )


def pixels(path: str, header: Header, chunk: tuple[int, int, int, int]) -> np.ndarray:
    """Values of a strip or tile; what of it lies beyond the raster is cut off."""
    row, column, offset, size = chunk
    raw = ranges.read(path, offset, size)
    raw = zlib.decompress(raw) if header.compression != PLAIN else raw
    rows = header.chunk_length if header.chunk_width < header.width or header.chunk_length * header.chunk_width * np.dtype(header.dtype).itemsize <= len(raw) else header.length - row
    values = np.frombuffer(raw, header.dtype, rows * header.chunk_width).reshape(rows, header.chunk_width)
    if header.predictor == 2:
        values = np.cumsum(values, axis=1, dtype=values.dtype)
    return values[: header.length - row, : header.width - column]


class Chunks(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        super().__init__((first, last))
        self.first, self.last = first, last


class RasterReader(DataSourceReader):
    def __init__(self, path: str, per_task: int | None) -> None:
        self.path, self.header = path, read_header(path)
        of_16_mb = max(1, (16 << 20) // max(1, self.header.chunk_width * self.header.chunk_length * 8))
        self.per_task = per_task or of_16_mb

    def partitions(self) -> list[Chunks]:
        n = len(self.header.chunks)
        return [Chunks(i, min(n, i + self.per_task)) for i in range(0, n, self.per_task)]

    def read(self, partition: Chunks) -> Iterator[pa.RecordBatch]:
        h = self.header
        for chunk in h.chunks[partition.first : partition.last]:
            values = pixels(self.path, h, chunk)
            for start in range(0, len(values), step := max(1, (1 << 18) // max(1, values.shape[1]))):
                part = values[start : start + step].astype(float)
                row, column = np.indices(part.shape, np.int32)
                n = part.size
                constant = lambda v: pa.array(np.full(n, v)) if v is not None else pa.nulls(n, pa.float64())  # noqa: B023, E731
                flat = [row.ravel() + np.int32(chunk[0] + start), column.ravel() + np.int32(chunk[1]), part.ravel()]
                columns = [pa.array(a) for a in flat] + [constant(v) for v in (*h.tie, *h.scale, h.nodata)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "col", "value", "tie_x", "tie_y", "scale_x", "scale_y", "nodata"])


class RasterSource(DataSource):
    """``spark.read.format("gridraster").load(path)``; option ``chunks`` is strips or tiles a task."""

    @classmethod
    def name(cls) -> str:
        return "gridraster"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RasterReader:
        return RasterReader(self.options["path"], int(self.options["chunks"]) if "chunks" in self.options else None)


def read(spark: SparkSession, path: str, chunks: int | None = None) -> DataFrame:
    """Pixels of a raster: row and col from the north-west, value, the tie point (x and y of the north-west
    corner), the scale in degrees, and the nodata value (null without one)."""
    spark.dataSource.register(RasterSource)
    reader = spark.read.format(RasterSource.name())
    return (reader.option("chunks", chunks) if chunks else reader).load(path)
