"""Polygons as the grid's squares, by a quadtree.

A polygon is cut into squares: one that it covers whole is one row however large, and is never clipped;
along its edge squares are quartered, each with its own piece of the rings only.  That is done in two
steps, so that a long coastline is many tasks: to squares of :data:`COARSE` cells a side, which are then
dealt anew, and from there to single cells.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import axes, rings

#: Cells a side of the squares that are dealt to tasks.
COARSE = 16
_RINGS = "array<array<double>>"


def _keys(polygons: DataFrame) -> list[str]:
    return [c for c in polygons.columns if c not in ("ring", "holes")]


def _flat(polygons: DataFrame) -> DataFrame:
    """Outer ring and holes as arrays x, y, x, y, ...; polygons without a ring are left out."""
    flat = lambda r: F.flatten(F.transform(r, lambda p: F.array(p["x"].cast("double"), p["y"].cast("double"))))
    outer = F.array(flat(F.col("ring")))
    if "holes" in polygons.columns:
        outer = F.concat(outer, F.coalesce(F.transform("holes", flat), F.array().cast(_RINGS)))
    keys = _keys(polygons)
    return polygons.where(F.size("ring") > 2).select(F.struct(*keys).alias("key"), outer.alias("rings"))


def _cutter(schema: T.StructType, stop: int, grid: axes.GridConfig, root: bool):
    form = to_arrow_schema(schema)
    top = 1 << int(np.ceil(np.log2(grid.columns)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key")
            places = [(0, 0, top)] * batch.num_rows if root else list(zip(*(batch.column(c).to_pylist() for c in ("row", "col", "size")), strict=True))
            of, out = [], []
            for i, (shape, place) in enumerate(zip(batch.column("rings").to_pylist(), places, strict=True)):
                parts = [np.asarray(r, float).reshape(-1, 2) for r in shape]
                for (row, column, size), whole, here in rings.quarter(parts, place, stop, grid.resolution, (grid.rows, grid.columns)):
                    x, y = (column + 0.5) * grid.resolution - 180, (row + 0.5) * grid.resolution - 90
                    centre = whole or (size == 1 and rings.contains(here, x, y))
                    area = (size * grid.resolution) ** 2 if whole else rings.shape_area(here)
                    out.append((row, column, size, whole, [r.ravel().tolist() for r in here], area, centre))
                    of.append(i)
                if len(out) >= 1024:
                    yield _batch(key, of, out, form)
                    of, out = [], []
            if out:
                yield _batch(key, of, out, form)

    return run


def _batch(key, of, out, form) -> pa.RecordBatch:
    columns = [key.take(pa.array(of)), *(pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), list(form)[1:], strict=True))]
    return pa.RecordBatch.from_arrays(columns, schema=form)


def squares(polygons: DataFrame, stop: int, grid: axes.GridConfig = axes.GRID) -> DataFrame:
    """key (all columns but ring and holes), row, col, size, whole, rings, area and centre of the squares that
    polygons (ring, holes, ...) meet, those at their edge being of ``stop`` cells a side at most.

    ``rings`` is the part in the square, empty where it is covered whole; ``area`` in square degrees;
    ``centre`` whether a single cell's centre is inside.  Parts beyond the grid are left out.
    """
    flat = _flat(polygons)
    schema = T.StructType([flat.schema["key"], *polygons.sparkSession.createDataFrame([], f"row int, col int, size int, whole boolean, rings {_RINGS}, area double, centre boolean").schema])
    coarse = flat.mapInArrow(_cutter(schema, max(stop, COARSE), grid, root=True), schema)
    if stop >= COARSE:
        return coarse
    edge = coarse.where("not whole").repartition(F.col("key"), "row", "col").mapInArrow(_cutter(schema, stop, grid, root=False), schema)
    return coarse.where("whole").unionByName(edge)


def cover(polygons: DataFrame, grid: axes.GridConfig = axes.GRID) -> DataFrame:
    """The columns of polygons but ring and holes, pgid, area and centre: each cell that each polygon meets."""
    met = squares(polygons, 1, grid)
    steps = F.sequence(F.lit(0), F.col("size") - 1)
    both = met.select("*", F.explode(steps).alias("_i")).select("*", F.explode(steps).alias("_j"))
    row, column = F.col("row") + F.col("_i"), F.col("col") + F.col("_j")
    # a square that is whole may be larger than what is left of the grid
    both = both.where((row < grid.rows) & (column < grid.columns))
    pgid = (row * grid.columns + column + 1).cast("int").alias("pgid")
    return both.select("key.*", pgid, F.when(F.col("whole"), grid.resolution**2).otherwise(F.col("area")).alias("area"), "centre")


def majority(cells: DataFrame, *groups: str) -> DataFrame:
    """groups, pgid, code and area of the largest overlap in each cell (of each group), ties (areas that differ
    by rounding) to the smaller code."""
    best = F.min(F.struct((-F.round("area", 9)).alias("order"), "code", "area"))
    return cells.where(F.round("area", 9) > 0).groupBy(*groups, "pgid").agg(best.alias("b")).select(*groups, "pgid", "b.code", "b.area")


def level_codes(polygons: DataFrame, levels: Sequence, missing: int | str = -1, by: str = "area", grid: axes.GridConfig = axes.GRID) -> DataFrame:
    """pgid and one column for each level (of polygons with level, code, ring and maybe holes), for every cell
    of the grid: the code with the largest area, or with ``by="centre"`` the least code that holds the centre;
    ``missing`` where there is none.  All levels come from one pass over the polygons."""
    if by not in ("area", "centre"):
        raise ValueError(f"no rule {by!r}; there are ['area', 'centre']")
    met = cover(polygons.where(F.col("level").isin(list(levels))), grid)
    won = majority(met, "level") if by == "area" else met.where("centre").groupBy("level", "pgid").agg(F.min("code").alias("code"))
    wide = won.groupBy("pgid").agg(*[F.max(F.when(F.col("level") == level, F.col("code"))).alias(str(level)) for level in levels])
    every = axes.cells(polygons.sparkSession, grid).select("pgid").join(wide, "pgid", "left")
    return every.select("pgid", *[F.coalesce(F.col(f"`{level}`"), F.lit(missing)).alias(str(level)) for level in levels])
