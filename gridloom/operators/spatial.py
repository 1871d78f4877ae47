"""Cells to polygons, by centre and by largest overlap, and polygons to polygons, by the area they share.

Cells come from the quadtree of :mod:`cover`, so polygons meet on cells and only pieces of rings are
looked at in detail.  Rings are arrays of (x, y); a polygon is
its outer ``ring`` less those in ``holes`` (an array of rings), where it has that column.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import axes, rings
from ..sources import snapshots
from . import cover


def box_cells(polygons: DataFrame, grid: axes.GridConfig = axes.GRID) -> DataFrame:
    """Polygons (code, west, south, east, north, ...) with each pgid that their box meets."""
    edge = lambda c, shift, n: F.least(F.greatest(F.floor((F.col(c) + shift) / grid.resolution), F.lit(0)), F.lit(n - 1)).cast("int")
    rows = polygons.withColumn("_row", F.explode(F.sequence(edge("south", 90, grid.rows), edge("north", 90, grid.rows))))
    both = rows.withColumn("_col", F.explode(F.sequence(edge("west", 180, grid.columns), edge("east", 180, grid.columns))))
    return both.withColumn("pgid", F.col("_row") * grid.columns + F.col("_col") + 1).drop("_row", "_col")


def with_box(polygons: DataFrame, ring: str = "ring") -> DataFrame:
    """Add west, south, east and north of a ring."""
    x, y = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return polygons.withColumns({"west": F.array_min(x), "south": F.array_min(y), "east": F.array_max(x), "north": F.array_max(y)})


def _with_holes(polygons: DataFrame) -> DataFrame:
    none = F.array().cast("array<array<struct<x:double,y:double>>>")
    return polygons.withColumn("holes", F.coalesce("holes", none) if "holes" in polygons.columns else none)


def _points(ring) -> np.ndarray:
    return np.array([(q["x"], q["y"]) for q in ring], float).reshape(-1, 2)


def centroid_join(polygons: DataFrame, grid: axes.GridConfig = axes.GRID) -> DataFrame:
    """pgid and the smallest code of the polygons (code, ring) that hold the cell's centre."""
    return cover.cover(polygons, grid).where("centre").groupBy("pgid").agg(F.min("code").alias("code"))


def area_majority_join(polygons: DataFrame, grid: axes.GridConfig = axes.GRID) -> DataFrame:
    """pgid, code and area (in square degrees) of the polygon with the largest overlap, ties to the
    smaller code."""
    return cover.majority(cover.cover(polygons, grid))


@F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
def _pieces(ring: pd.Series, holes: pd.Series, west: pd.Series, south: pd.Series, east: pd.Series, north: pd.Series) -> pd.Series:
    """The rings of a polygon in a box, each as x, y, x, y, ...."""
    out = []
    for outer, inner, *box in zip(ring, holes, west, south, east, north, strict=True):
        parts = [rings.clip_to_box(_points(r), *box) for r in (outer, *inner)]
        out.append([p.ravel().tolist() for p in parts if len(p) > 2])
    return pd.Series(out, dtype=object)


def _edges(rings) -> np.ndarray:
    """Edges x0, y0, x1, y1 that are not level, of rings as x, y, x, y, ...."""
    both = [np.hstack([p, np.roll(p, -1, axis=0)]) for p in (np.asarray(r, float).reshape(-1, 2) for r in rings)]
    edges = np.vstack(both) if both else np.empty((0, 4))
    return edges[edges[:, 1] != edges[:, 3]]


def _heights_of_crossings(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """y where an edge of one set crosses one of the other."""
    d, f = a[:, None, 2:] - a[:, None, :2], b[None, :, 2:] - b[None, :, :2]
    g = b[None, :, :2] - a[:, None, :2]
    turn = d[..., 0] * f[..., 1] - d[..., 1] * f[..., 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (g[..., 0] * f[..., 1] - g[..., 1] * f[..., 0]) / turn
        u = (g[..., 0] * d[..., 1] - g[..., 1] * d[..., 0]) / turn
    meet = (turn != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    return (a[:, None, 1] + t * d[..., 1])[meet]


def _spans(edges: np.ndarray, y: float) -> np.ndarray:
    """Starts and ends, in turn, of what is inside on a parallel (even-odd rule)."""
    cut = edges[(edges[:, 1] > y) != (edges[:, 3] > y)]
    return np.sort(cut[:, 0] + (y - cut[:, 1]) * (cut[:, 2] - cut[:, 0]) / (cut[:, 3] - cut[:, 1]))


def _common_area(one, other) -> float:
    """Area inside both of two sets of rings.  Between two heights where edges end or cross, the common
    width is linear in y, so its value in the middle counts for the whole strip."""
    a, b = _edges(one), _edges(other)
    if not len(a) or not len(b):
        return 0.0
    y = np.unique(np.concatenate([a[:, [1, 3]].ravel(), b[:, [1, 3]].ravel(), _heights_of_crossings(a, b)]))
    area = 0.0
    for low, high in zip(y[:-1], y[1:], strict=True):
        p, q = _spans(a, (low + high) / 2), _spans(b, (low + high) / 2)
        if len(p) and len(q):
            wide = np.minimum(p[1::2, None], q[None, 1::2]) - np.maximum(p[::2, None], q[None, ::2])
            area += (high - low) * float(np.maximum(wide, 0).sum())
    return area


@F.pandas_udf(T.DoubleType())
def _common(one: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([_common_area(a, b) for a, b in zip(one, other, strict=True)], dtype=float)


@F.pandas_udf(T.DoubleType())
def _area(ring: pd.Series, holes: pd.Series) -> pd.Series:
    return pd.Series([rings.shape_area([_points(r) for r in (outer, *inner)]) for outer, inner in zip(ring, holes, strict=True)], dtype=float)


def coverage(supplements: DataFrame, polygons: DataFrame, grid: axes.GridConfig = axes.GRID) -> DataFrame:
    """code, covered: the largest share of each supplement's area that one polygon covers.

    Both (code, ring) are cut by cell first, so the join is on the cell and carries pieces of rings.
    """

    def cut(shapes: DataFrame, code: str, piece: str) -> DataFrame:
        near = box_cells(with_box(_with_holes(shapes)), grid).withColumn("_box", axes.bounding_box(F.col("pgid"), grid))
        parts = near.select("pgid", F.col("code").alias(code), _pieces("ring", "holes", "_box.west", "_box.south", "_box.east", "_box.north").alias(piece))
        return parts.where(F.size(piece) > 0)

    both = cut(supplements, "code", "_a").join(cut(polygons, "_by", "_b"), "pgid")
    shared = both.groupBy("code", "_by").agg(F.sum(_common("_a", "_b")).alias("_shared")).groupBy("code").agg(F.max("_shared").alias("_shared"))
    sizes = _with_holes(supplements).select("code", _area("ring", "holes").alias("_size")).groupBy("code").agg(F.sum("_size").alias("_size"))
    return sizes.join(shared, "code", "left").select("code", F.coalesce(F.try_divide("_shared", "_size"), F.lit(0.0)).alias("covered"))


def uncovered(supplements: DataFrame, polygons: DataFrame, threshold: float = 0.5, grid: axes.GridConfig = axes.GRID) -> DataFrame:
    """Supplements of which no polygon covers more than ``threshold``."""
    taken = coverage(supplements, polygons, grid).where(F.col("covered") > threshold)
    return supplements.join(taken.select("code"), "code", "left_anti")


@F.pandas_udf(T.DoubleType())
def _distance(x: pd.Series, y: pd.Series, piece: pd.Series) -> pd.Series:
    return pd.Series([rings.distance([np.asarray(r, float).reshape(-1, 2) for r in parts], a, b) for a, b, parts in zip(x, y, piece, strict=True)], dtype=float)


def _box_ring(grid: axes.GridConfig) -> Column:
    west, south = F.col("col") * grid.resolution - 180, F.col("row") * grid.resolution - 90
    east, north = west + F.col("size") * grid.resolution, south + F.col("size") * grid.resolution
    return F.array(F.array(west, south, east, south, east, north, west, north))


def _not_farther(seen: DataFrame) -> DataFrame:
    """(lat, lon, code, _id) of pieces whose box is no farther from a position than the nearest of the pieces' corners."""
    off = lambda low, at, high: F.greatest(F.col(low) - F.col(at), F.lit(0.0), F.col(at) - F.col(high))
    least = F.hypot(off("_west", "lon", "_east"), off("_south", "lat", "_north"))
    most = F.hypot(F.col("_cx") - F.col("lon"), F.col("_cy") - F.col("lat"))
    bounded = seen.select("lat", "lon", "code", "_id", least.alias("_least"), most.alias("_most"))
    nearest = F.min("_most").over(Window.partitionBy("lat", "lon"))
    return bounded.withColumn("_nearest", nearest).where(F.col("_least") <= F.col("_nearest") + 1e-9).select("lat", "lon", "code", "_id")  # rounding


def nearest_polygon(points: DataFrame, polygons: DataFrame, square: float = 2.0, measure: str = "centre", grid: axes.GridConfig = axes.GRID) -> DataFrame:
    """Points (pgid, lat, lon) with the code of the nearest polygon, ties to the smaller code, and its distance
    in degrees: of the centre of its box, or with ``measure="edge"`` of the polygon itself (0 inside).

    A position (of however many points) looks at what lies in its square and the eight around it, which holds
    all within a square's width; where the best is farther, or there is none, squares twice as wide come next, for
    such positions only, until none is left; each round is written to the shared folder.  Polygons are looked at as
    their pieces in single cells, which no square cuts; those whose box is farther than a corner of another piece
    cannot be nearest, so only the few others are measured.
    """
    if measure == "centre":
        mid = lambda a, b: (F.col(a) + F.col(b)) / 2
        targets = with_box(polygons).select("code", mid("west", "east").alias("_x"), mid("south", "north").alias("_y"))
        away = F.sqrt(F.pow(F.col("lon") - F.col("_x"), 2) + F.pow(F.col("lat") - F.col("_y"), 2))
    elif measure == "edge":
        met = cover.squares(polygons.select("code", *[c for c in ("ring", "holes") if c in polygons.columns]), 1, grid)
        steps = F.when(F.col("whole"), F.sequence(F.lit(0), F.col("size") - 1)).otherwise(F.array(F.lit(0)))
        cells = met.select("*", F.explode(steps).alias("_r")).select("*", F.explode(steps).alias("_c"))
        cells = cells.withColumns({"row": F.col("row") + F.col("_r"), "col": F.col("col") + F.col("_c"), "size": F.lit(1)})
        centre = lambda c, o: (F.col(c) + 0.5) * grid.resolution - o
        piece = F.when(F.col("whole"), _box_ring(grid)).otherwise(F.col("rings"))
        targets = cells.select("key.code", centre("col", 180).alias("_x"), centre("row", 90).alias("_y"), piece.alias("_piece"), F.flatten(piece).alias("_flat"))
        every = lambda odd: F.filter("_flat", lambda v, i: i % 2 == odd)
        box = {"_west": F.array_min(every(0)), "_south": F.array_min(every(1)), "_east": F.array_max(every(0)), "_north": F.array_max(every(1))}
        corner = {"_cx": F.element_at("_flat", 1), "_cy": F.element_at("_flat", 2)}
        targets = targets.withColumns(box | corner | {"_id": F.monotonically_increasing_id()}).drop("_flat")
        away = _distance("lon", "lat", "_piece")
    else:
        raise ValueError(f"no measure {measure!r}; there are ['centre', 'edge']")
    targets = snapshots.written(targets, "targets")
    kind = dict(targets.dtypes)["code"]
    open_ = points.select("lat", "lon").where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).distinct()
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done: list[DataFrame] = []
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    reach = square
    while True:
        at = lambda x, y: [F.floor((x + 180) / reach).alias("_i"), F.floor((y + 90) / reach).alias("_j")]  # noqa: B023, E731
        i, j = at(F.col("lon"), F.col("lat"))
        here = open_.repartition(tasks, "lat", "lon").withColumn("_step", F.explode(steps))
        here = here.withColumns({"_i": i + F.col("_step.i"), "_j": j + F.col("_step.j")}).drop("_step")
        seen = here.join(targets.drop("_piece").select("*", *at(F.col("_x"), F.col("_y"))), ["_i", "_j"])
        seen = seen if measure == "centre" else _not_farther(seen).join(targets.select("_id", "_piece"), "_id")
        best = seen.groupBy("lat", "lon").agg(F.min(F.struct(away.alias("distance"), F.col("code").alias("code"))).alias("_best"))
        looked = snapshots.written(open_.join(best, ["lat", "lon"], "left"), "looked")
        near = F.coalesce(F.col("_best.distance") <= reach, F.lit(False))
        last = reach >= 360
        done.append(looked.where(F.col("_best").isNotNull() if last else near))
        open_ = looked.where(~near).drop("_best")
        if last or open_.isEmpty():
            break
        reach *= 2
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    found = points.select("pgid", "lat", "lon").join(found, ["lat", "lon"])
    found = found.select("pgid", F.col("_best").cast(f"struct<distance:double,code:{kind}>").alias("_best"))
    return found.groupBy("pgid").agg(F.min("_best").alias("_best")).select("pgid", "_best.code", "_best.distance")
