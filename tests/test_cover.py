"""Polygons by quadtree against plain clipping of every cell, and against points."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from gridloom.functions import axes, rings
from gridloom.operators import cover, spatial
from pyspark.sql import functions as F

KIND = "code int, ring array<struct<x:double,y:double>>, holes array<array<struct<x:double,y:double>>>"


def star(x, y, size, n, rng):
    at = [(size * (1 if i % 2 else 0.4 + 0.4 * rng.random()), 2 * math.pi * i / n) for i in range(n)]
    return [(x + r * math.cos(a), y + r * math.sin(a)) for r, a in at]


def shapes(rng):
    out = []
    for code in range(1, 7):
        x, y, size = rng.uniform(-150, 150), rng.uniform(-60, 60), rng.choice([0.3, 3, 20])
        ring = star(x, y, size, 2 * rng.randrange(5, 40), rng)
        holes = [star(x + size * 0.1, y, size * 0.2, 12, rng)] if code % 2 else []
        out.append((code, ring, holes))
    out.append((7, [(0, 0), (40, 0), (40, 20), (0, 20)], [[(5, 5), (35, 5), (35, 15), (5, 15)]]))  # a frame
    out.append((8, [(170, 80), (200, 80), (200, 100), (170, 100)], []))  # over the grid's corner
    return out


def table(spark, polygons):
    point = lambda p: {"x": float(p[0]), "y": float(p[1])}
    return spark.createDataFrame([(c, [point(p) for p in r], [[point(p) for p in h] for h in hs]) for c, r, hs in polygons], KIND)


def plain(polygons):
    """(code, pgid) to (area, centre) by clipping each cell of the box."""
    out = {}
    for code, ring, holes in polygons:
        parts = [np.array(r, float) for r in (ring, *holes)]
        (west, south), (east, north) = parts[0].min(0), parts[0].max(0)
        for row in range(max(0, int((south + 90) // 0.5)), min(359, int((north + 90) // 0.5)) + 1):
            for column in range(max(0, int((west + 180) // 0.5)), min(719, int((east + 180) // 0.5)) + 1):
                w, s = column * 0.5 - 180, row * 0.5 - 90
                area = rings.shape_area([rings.clip_to_box(p, w, s, w + 0.5, s + 0.5) for p in parts])
                if area > 1e-9:
                    out[code, row * 720 + column + 1] = (area, rings.contains(parts, w + 0.25, s + 0.25))
    return out


@pytest.fixture(scope="module")
def polygons():
    return shapes(random.Random(12))


def test_clipping_equals_point_by_point():
    rng = random.Random(1)
    for _ in range(50):
        ring = np.array(star(0, 0, 2, 2 * rng.randrange(2, 9), rng))
        for axis in (0, 1):
            for below in (True, False):
                want = []
                for i in range(len(ring)):
                    p, q = ring[i - 1], ring[i]
                    inside = lambda v: v[axis] <= 0.3 if below else v[axis] >= 0.3  # noqa: B023, E731
                    if inside(p) != inside(q):
                        want.append(p + (0.3 - p[axis]) / (q[axis] - p[axis]) * (q - p))
                    if inside(q):
                        want.append(q)
                assert np.allclose(rings.clip(ring, axis, 0.3, below), np.array(want).reshape(-1, 2))


def test_areas_and_centres_of_stars_and_holes(spark, polygons):
    met = {(r["code"], r["pgid"]): (r["area"], r["centre"]) for r in cover.cover(table(spark, polygons)).collect() if r["area"] > 1e-9}
    want = plain(polygons)
    assert met.keys() == want.keys()
    assert all(abs(met[k][0] - want[k][0]) < 1e-9 and met[k][1] == want[k][1] for k in want)


def test_joins_equal_those_of_every_cell(spark, polygons):
    overlapping = [*polygons, *[(c + 20, [(x + 0.2, y + 0.1) for x, y in r], [[(x, y) for x, y in h] for h in hs]) for c, r, hs in polygons]]
    want = plain(overlapping)
    cells = {p for _, p in want}
    area, centre = {}, {}
    for (code, pgid), (size, inside) in sorted(want.items()):
        if pgid not in area or round(size, 9) > round(area[pgid][1], 9):
            area[pgid] = (code, size)
        if inside:
            centre.setdefault(pgid, code)
    rows = table(spark, overlapping)
    assert {r["pgid"]: r["code"] for r in spatial.area_majority_join(rows).collect()} == {p: area[p][0] for p in cells}
    assert {r["pgid"]: r["code"] for r in spatial.centroid_join(rows).collect()} == centre


def test_all_levels_in_one_pass_and_uncovered_cells(spark, polygons):
    rows = table(spark, polygons).withColumn("level", F.when(F.col("code") % 2 == 0, 0).otherwise(2))
    found = {r["pgid"]: (r["0"], r["2"]) for r in cover.level_codes(rows, [0, 2]).collect()}
    assert len(found) == 259_200
    for which, parity in ((0, 0), (1, 1)):
        alone = {r["pgid"]: r["code"] for r in spatial.area_majority_join(table(spark, [p for p in polygons if p[0] % 2 == parity])).collect()}
        assert all(found[p][which] == alone.get(p, -1) for p in found)
    words = rows.withColumn("code", F.concat(F.lit("c"), "code")).where("level = 0")
    named = cover.level_codes(words, [0], missing="", by="centre")
    assert named.where("`0` = ''").count() + named.where("`0` like 'c%'").count() == 259_200
    with pytest.raises(ValueError, match="no rule"):
        cover.level_codes(rows, [0], by="weight")


def test_long_rings_are_cut_once_and_not_sent_for_each_cell(spark):
    n = 10_000
    ring = [(30 * math.cos(2 * math.pi * i / n), 30 * math.sin(2 * math.pi * i / n)) for i in range(n)]
    rows = table(spark, [(1, ring, [])])
    before = spatial.box_cells(spatial.with_box(rows)).count() * n  # a ring for each cell of the box
    edge = cover.squares(rows, cover.COARSE).agg(F.sum(F.size(F.flatten("rings")) / 2)).head()[0]
    assert n + edge < before / 10 and n + edge < 3 * n
    area = cover.cover(rows).agg(F.sum("area")).head()[0]
    assert abs(area - math.pi * 900) < 0.01


def test_awkward_polygons(spark):
    none = spark.createDataFrame([], KIND)
    assert cover.cover(none).count() == 0
    rows = table(spark, [(1, [(0, 0), (1, 1)], []), (2, [(0, 0), (1, 0), (2, 0)], []), (3, [(0, 0), (1e-3, 0), (0, 1e-3)], [])])
    rows = rows.unionByName(spark.createDataFrame([(4, None, None), (5, [{"x": 1.0, "y": 1.0}, {"x": 2.0, "y": 1.0}, {"x": 2.0, "y": 2.0}], None)], KIND))
    got = {r["code"]: round(r["area"], 9) for r in cover.cover(rows).groupBy("code").agg(F.sum("area").alias("area")).collect()}
    assert got == {3: 5e-7, 5: 0.5}
    coarse = axes.GridConfig(90.0)
    assert cover.cover(table(spark, [(1, [(-180, -90), (0, -90), (0, 90), (-180, 90)], [])]), coarse).where("centre").count() == 4


def test_nearest_by_edge_equals_distances_to_all(spark, polygons):
    rng = random.Random(9)
    points = [(i, rng.uniform(-89, 89), rng.uniform(-179, 179)) for i in range(40)] + [(40, 10.0, 20.0), (41, 2.0, 2.0)]
    inside = [p for p in polygons if p[0] != 8]
    parts = {c: [np.array(r, float) for r in (ring, *holes)] for c, ring, holes in inside}
    want = {i: min((rings.distance(p, lon, lat), c) for c, p in parts.items()) for i, lat, lon in points}
    frame = spark.createDataFrame([*points, (99, None, 1.0)], "pgid int, lat double, lon double")
    got = {r["pgid"]: (r["distance"], r["code"]) for r in spatial.nearest_polygon(frame, table(spark, inside), measure="edge").collect()}
    assert got.keys() == want.keys() and all(abs(got[i][0] - want[i][0]) < 1e-9 and got[i][1] == want[i][1] for i in want)
    assert got[41][0] == 0.0
    assert spatial.nearest_polygon(frame, table(spark, inside).limit(0)).count() == 0


def test_nearest_stops_when_all_points_are_settled(spark, polygons, monkeypatch):
    rounds = []
    real = type(spark.range(1)).isEmpty
    monkeypatch.setattr(type(spark.range(1)), "isEmpty", lambda self: (rounds.append(1), real(self))[1])
    square = table(spark, [(1, [(0, 0), (1, 0), (1, 1), (0, 1)], [])])
    spatial.nearest_polygon(spark.createDataFrame([(1, 0.5, 0.9)], "pgid int, lat double, lon double"), square)
    assert len(rounds) == 1
