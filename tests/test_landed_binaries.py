"""Rasters and shapefiles that are written here, byte by byte."""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pytest
from gridloom.operators import cover, gridagg
from gridloom.sources import raster, shapefile, snapshots
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tiff(values, order="<", big=False, strip=None, tile=None, deflate=False, predictor=1, leave_out=(), nodata=b"-200\0", samples=1):
    """A GeoTIFF of one band."""
    values = values.astype(values.dtype.newbyteorder(order))
    length, width = values.shape
    chunks = []
    if tile:
        for r in range(0, length, tile):
            for c in range(0, width, tile):
                part = np.zeros((tile, tile), values.dtype)
                cut = values[r : r + tile, c : c + tile]
                part[: cut.shape[0], : cut.shape[1]] = cut
                chunks.append(part)
    else:
        strip = strip or length
        chunks = [values[r : r + strip] for r in range(0, length, strip)]
    if predictor == 2:
        chunks = [np.concatenate([p[:, :1], np.diff(p, axis=1)], axis=1).astype(values.dtype) for p in chunks]
    packed = [zlib.compress(p.tobytes()) if deflate else p.tobytes() for p in chunks]
    start = 16 if big else 8
    offsets = [start + sum(map(len, packed[:i])) for i in range(len(packed))]
    body = b"".join(packed)
    kind = {"u": 1, "i": 2, "f": 3}[values.dtype.kind]
    tags = {256: ("I", [width]), 257: ("I", [length]), 258: ("H", [values.dtype.itemsize * 8]), 259: ("H", [8 if deflate else 1]), 277: ("H", [samples]), 317: ("H", [predictor]), 339: ("H", [kind]), 33550: ("d", [0.5, 0.5, 0.0]), 33922: ("d", [0.0, 0.0, 0.0, -180.0, 90.0, 0.0]), 42113: ("s", nodata)}
    tags |= {322: ("I", [tile]), 323: ("I", [tile]), 324: ("I", offsets), 325: ("I", list(map(len, packed)))} if tile else {273: ("I", offsets), 278: ("I", [strip]), 279: ("I", list(map(len, packed)))}
    tags = {k: v for k, v in tags.items() if k not in leave_out}
    at = start + len(body)
    extra_at = at + (8 + 20 * len(tags) + 8 if big else 2 + 12 * len(tags) + 4)
    entries, extra = b"", b""
    room, word = (8, "Q") if big else (4, "I")
    for tag, (code, data) in sorted(tags.items()):
        raw = data if code == "s" else struct.pack(f"{order}{len(data)}{code}", *data)
        entries += struct.pack(f"{order}HH{word}", tag, {"H": 3, "I": 4, "d": 12, "s": 2}[code], len(data))
        if len(raw) <= room:
            entries += raw.ljust(room, b"\0")
        else:
            entries += struct.pack(f"{order}{word}", extra_at + len(extra))
            extra += raw
    mark = {"<": b"II", ">": b"MM"}[order]
    head = mark + (struct.pack(f"{order}HHHQ", 43, 8, 0, at) if big else struct.pack(f"{order}HI", 42, at))
    return head + body + struct.pack(f"{order}{'Q' if big else 'H'}", len(tags)) + entries + bytes(room) + extra


VALUES = (np.arange(360 * 7, dtype=np.float32).reshape(36, 70) % 97) - 3
SHAPES = [
    {}, {"strip": 5}, {"strip": 5, "deflate": True}, {"strip": 7, "order": ">"}, {"tile": 16}, {"tile": 16, "deflate": True, "big": True}, {"strip": 4, "big": True, "order": ">"},
]


@pytest.mark.parametrize("how", SHAPES, ids=str)
def test_pixels_of_a_raster(spark, tmp_path, how):
    path = str(tmp_path / "r.tif")
    (tmp_path / "r.tif").write_bytes(tiff(VALUES, **how))
    table = raster.read(spark, path, chunks=2)
    assert table.rdd.getNumPartitions() == -(-len(raster.read_header(path).chunks) // 2)
    got = np.zeros(VALUES.shape)
    rows = table.collect()
    for r in rows:
        got[r["row"], r["col"]] = r["value"]
    assert len(rows) == VALUES.size and (got == VALUES).all()
    assert tuple(rows[0])[3:] == (-180.0, 90.0, 0.5, 0.5, -200.0)


@pytest.mark.parametrize("kind", ["u1", "i2", "u4", "f8"])
def test_kinds_and_the_predictor(spark, tmp_path, kind):
    values = (np.arange(60).reshape(6, 10) * 3 % 50).astype(kind)
    (tmp_path / "r.tif").write_bytes(tiff(values, strip=4, deflate=True, predictor=1 if kind == "f8" else 2))
    got = {(r["row"], r["col"]): r["value"] for r in raster.read(spark, f"file://{tmp_path}/r.tif").collect()}
    assert got == {(i, j): float(values[i, j]) for i in range(6) for j in range(10)}


def test_missing_tags_and_other_codes_are_errors(tmp_path):
    path = str(tmp_path / "r.tif")
    for how, what in (({"leave_out": (33550,)}, "pixel scale"), ({"leave_out": (33922, 256)}, "width and no tie point"), ({"samples": 3}, "3 bands"), ({"predictor": 3}, "predictor 3"), ({"leave_out": (273,)}, "strips")):
        (tmp_path / "r.tif").write_bytes(tiff(VALUES, **how))
        with pytest.raises(ValueError, match=what):
            raster.read_header(path)
    (tmp_path / "r.tif").write_bytes(b"no raster at all")
    with pytest.raises(ValueError, match="no TIFF"):
        raster.read_header(path)
    (tmp_path / "r.tif").write_bytes(tiff(VALUES, nodata=b"", leave_out=(42113,)))
    assert raster.read_header(path).nodata is None


def test_a_raster_goes_through_blocks_to_cells(spark, tmp_path):
    values = np.ones((720, 1440), np.float32)
    values[0, 0], values[719, 1439] = -200, 5
    (tmp_path / "r.tif").write_bytes(tiff(values, strip=90, deflate=True))
    table = raster.read(spark, str(tmp_path / "r.tif"))
    blocks = gridagg.raster_blocks(table, 2, nodata=-200.0)
    cells = blocks.select(gridagg.raster_block_to_pgid(F.col("block_row"), F.col("block_col")).alias("pgid"), "value")
    got = cells.agg(F.count(F.lit(1)), F.sum("value"), F.min_by("pgid", "value"), F.max_by("pgid", "value")).head()
    assert tuple(got) == (259_200, 720 * 1440 - 1 + 4.0, 359 * 720 + 1, 720)


def shp(tmp_path, shapes, names=(("code", "N", 6, 0), ("name", "C", 12, 0), ("share", "N", 8, 3), ("open", "L", 1, 0))):
    """A shapefile of (attributes, rings as written)."""
    content, index, rows = b"", b"", b""
    for i, (values, parts) in enumerate(shapes):
        points = [p for ring in parts or () for p in ring]
        if parts is None:
            record = struct.pack("<i", 0)
        else:
            starts = np.cumsum([0, *map(len, parts)])[:-1]
            record = struct.pack("<i4dii", 5, 0, 0, 0, 0, len(parts), len(points)) + struct.pack(f"<{len(parts)}i", *starts) + struct.pack(f"<{2 * len(points)}d", *[c for p in points for c in p])
        index += struct.pack(">ii", (100 + len(content)) // 2, len(record) // 2)
        content += struct.pack(">ii", i + 1, len(record) // 2) + record
        rows += b" " + b"".join(("" if v is None else str(v)).encode().ljust(size)[:size] for v, (_, _, size, _) in zip(values, names))
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, 0)[:28] + struct.pack("<ii", 1000, 5) + bytes(64)
    (tmp_path / "s.shp").write_bytes(head + content)
    (tmp_path / "s.shx").write_bytes(head + index)
    described = b"".join(n.encode().ljust(11, b"\0") + k.encode() + bytes(4) + bytes([size, d]) + bytes(14) for n, k, size, d in names)
    (tmp_path / "s.dbf").write_bytes(struct.pack("<B3BIHH20x", 3, 99, 1, 1, len(shapes), 33 + 32 * len(names), 1 + sum(n[2] for n in names)) + described + b"\r" + rows)
    return str(tmp_path / "s.shp")


def ring(w, s, e, n, clockwise=True):
    p = [(w, s), (w, n), (e, n), (e, s), (w, s)]
    return p if clockwise else p[::-1]


def test_shapes_equal_those_of_geojson(spark, tmp_path):
    shapes = [
        ((1, "één", 0.5, "T"), [ring(0, 0, 4, 4), ring(1, 1, 2, 2, False), ring(10, 10, 12, 12)]),
        ((2, None, None, "?"), None),
        ((3, "three", 1.25, "F"), [ring(20, 0, 30, 10), ring(21, 1, 29, 9, False), ring(22, 2, 28, 8), ring(23, 3, 24, 4, False)]),
        ((None, "x", 2, None), [ring(-5.25, -5, -4, -4)]),
    ]
    path = shp(tmp_path, shapes)
    found = shapefile.read(spark, path, records=2)
    assert found.rdd.getNumPartitions() == 2
    assert [(f.name, f.dataType.simpleString()) for f in found.schema][:4] == [("code", "bigint"), ("name", "string"), ("share", "double"), ("open", "boolean")]
    geometry = lambda *polygons: {"type": "MultiPolygon", "coordinates": list(polygons)}
    features = [
        (1, "één", 0.5, True, geometry([ring(0, 0, 4, 4), ring(1, 1, 2, 2, False)], [ring(10, 10, 12, 12)])),
        (3, "three", 1.25, False, geometry([ring(20, 0, 30, 10), ring(21, 1, 29, 9, False)], [ring(22, 2, 28, 8), ring(23, 3, 24, 4, False)])),
        (None, "x", 2.0, None, geometry([ring(-5.25, -5, -4, -4)])),
    ]
    (tmp_path / "s.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": dict(zip(("code", "name", "share", "open"), f)), "geometry": f[4]} for f in features]}))
    want = snapshots.read_geojson(spark, str(tmp_path / "s.geojson"), T.StructType(found.schema.fields[:4]))
    order = lambda df: sorted(map(str, df.select("code", "name", "share", "open", "ring", "holes").collect()))
    assert order(found) == order(want)
    assert cover.cover(found.where("code = 3").select("code", "ring", "holes")).agg(F.sum("area")).head()[0] == pytest.approx(100 - 64 + 36 - 1)


def test_other_shapes_and_lengths_are_errors(tmp_path):
    path = shp(tmp_path, [((1, "a", 1, "T"), [ring(0, 0, 1, 1)])])
    table = (tmp_path / "s.dbf").read_bytes()
    (tmp_path / "s.dbf").write_bytes(table[:4] + struct.pack("<I", 2) + table[8:])
    with pytest.raises(ValueError, match="1 shapes and 2 rows"):
        shapefile.ShapeReader(path, None, 10, "utf-8")
    raw = (tmp_path / "s.shp").read_bytes()
    (tmp_path / "s.shp").write_bytes(raw[:32] + struct.pack("<i", 1) + raw[36:])
    with pytest.raises(ValueError, match="type 1"):
        shapefile.ShapeReader(path, None, 10, "utf-8")
