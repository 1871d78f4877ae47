"""Shapefiles as tables of polygons: a Python data source with tasks for ranges of the index.

The index (.shx) has each record's place, and records of the attribute table (.dbf) are of one length, so a
task reads only its own part of both files.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import rings
from . import ranges

# Shape types of the format that are polygons, and none.
NULL, POLYGONS = 0, (5, 15, 25)
_POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def _beside(path: str, kind: str) -> str:
    return path[:-3] + kind if path.lower().endswith("shp") else f"{path}.{kind}"


def fields(path: str) -> tuple[int, int, int, list[tuple[str, str, int, int]]]:
    """Of an attribute table: records, header and record bytes, and (name, type, bytes, decimals) of its fields."""
    head = ranges.read(path, 0, 32)
    n, start, size = struct.unpack("<IHH", head[4:12])
    raw, out = ranges.read(path, 32, start - 32), []
    for i in range(0, len(raw) - 31, 32):
        if raw[i] == 0x0D:
            break
        name = raw[i : i + 11].split(b"\0")[0].decode("ascii", "replace")
        out.append((name, chr(raw[i + 11]), raw[i + 16], raw[i + 17]))
    return n, start, size, out


def _type(kind: str, decimals: int) -> T.DataType:
    if kind in "NF":
        return T.DoubleType() if decimals or kind == "F" else T.LongType()
    return T.BooleanType() if kind == "L" else T.StringType()


def _value(raw: bytes, kind: str, decimals: int, encoding: str):
    text = raw.decode(encoding, "replace").strip(" \0")
    if not text or set(text) == {"*"}:
        return None
    if kind in "NF":
        return float(text) if decimals or kind == "F" else int(float(text))
    return (text in "TtYy" if text != "?" else None) if kind == "L" else text


def polygons(content: bytes) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Outer rings of a record with their holes.  Outer rings run clockwise; a hole belongs to the least of the larger outer
    rings around its first point or its middle, and one that lies in none is an outer ring of its own."""
    n_parts, n_points = struct.unpack("<ii", content[36:44])
    starts = [*struct.unpack(f"<{n_parts}i", content[44 : 44 + 4 * n_parts]), n_points]
    points = np.frombuffer(content, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(-1, 2)
    parts = [points[a:b] for a, b in zip(starts, starts[1:]) if b - a >= 3]
    turn = lambda p: float((p[:, 0] * np.roll(p[:, 1], -1) - np.roll(p[:, 0], -1) * p[:, 1]).sum())
    out = [(p, []) for p in parts if turn(p) <= 0]
    lone = []
    for hole in (p for p in parts if turn(p) > 0):
        around = [o for o in out if rings.area(o[0]) > rings.area(hole) and (rings.contains([o[0]], *hole[0]) or rings.contains([o[0]], *hole.mean(axis=0)))]
        if around:
            min(around, key=lambda o: rings.area(o[0]))[1].append(hole)
        else:
            lone.append((hole, []))
    return out + lone


class Records(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        super().__init__((first, last))
        self.first, self.last = first, last


class ShapeReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, per_task: int, encoding: str) -> None:
        self.path, self.schema, self.per_task, self.encoding = path, schema, per_task, encoding
        kind = struct.unpack("<i", ranges.read(path, 32, 4))[0]
        if kind not in (NULL, *POLYGONS):
            raise ValueError(f"{path} has shapes of type {kind}; polygons are read")
        self.n = (ranges.size(_beside(path, "shx")) - 100) // 8
        rows = fields(_beside(path, "dbf"))[0]
        if rows != self.n:
            raise ValueError(f"{path} has {self.n} shapes and {rows} rows of attributes")

    def partitions(self) -> list[Records]:
        return [Records(i, min(self.n, i + self.per_task)) for i in range(0, self.n, self.per_task)]

    def read(self, partition: Records) -> Iterator[pa.RecordBatch]:
        first, last = partition.first, partition.last
        index = struct.unpack(f">{2 * (last - first)}i", ranges.read(_beside(self.path, "shx"), 100 + 8 * first, 8 * (last - first)))
        _, start, size, names = fields(_beside(self.path, "dbf"))
        rows = ranges.read(_beside(self.path, "dbf"), start + size * first, size * (last - first))
        form, out = to_arrow_schema(self.schema), []
        for i in range(last - first):
            content = ranges.read(self.path, 2 * index[2 * i] + 8, 2 * index[2 * i + 1])
            if struct.unpack("<i", content[:4])[0] == NULL:
                continue
            at, values = size * i + 1, []
            for _, kind, length, decimals in names:
                values.append(_value(rows[at : at + length], kind, decimals, self.encoding))
                at += length
            points = lambda ring: [{"x": x, "y": y} for x, y in ring.tolist()]
            out += [(*values, points(outer), [points(h) for h in holes]) for outer, holes in polygons(content)]
            if len(out) >= 256 or (out and i == last - first - 1):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), form, strict=True)], schema=form)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), form, strict=True)], schema=form)


class ShapeSource(DataSource):
    """``spark.read.format("gridshapes").load(path)``; options ``records`` (a task) and ``encoding``."""

    @classmethod
    def name(cls) -> str:
        return "gridshapes"

    def schema(self) -> T.StructType:
        names = fields(_beside(self.options["path"], "dbf"))[3]
        ring = T.ArrayType(_POINT)
        return T.StructType([T.StructField(n, _type(kind, decimals)) for n, kind, _, decimals in names] + [T.StructField("ring", ring), T.StructField("holes", T.ArrayType(ring))])

    def reader(self, schema) -> ShapeReader:
        return ShapeReader(self.options["path"], self.schema(), int(self.options.get("records", 256)), self.options.get("encoding", "utf-8"))


def read(spark: SparkSession, path: str, records: int = 256, encoding: str = "utf-8") -> DataFrame:
    """Polygons of a shapefile as (attributes..., outer ring of x and y, holes), a row for each outer ring, as
    GeoJSON is read; null shapes are skipped, other shapes an error."""
    spark.dataSource.register(ShapeSource)
    return spark.read.format(ShapeSource.name()).option("records", records).option("encoding", encoding).load(path)
