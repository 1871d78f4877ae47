"""The nearest polygon by its edge, of which few pieces are measured."""

from __future__ import annotations

import random

import numpy as np
from gridloom.functions import rings
from gridloom.operators import spatial


def test_few_pieces_of_a_far_polygon_are_measured(spark):
    pieces = [(i, i * 0.5, 10.0, i * 0.5 + 0.5, 10.5, i * 0.5, 10.0) for i in range(100)]
    frame = spark.createDataFrame(pieces, "_id long, _west double, _south double, _east double, _north double, _cx double, _cy double")
    seen = frame.crossJoin(spark.createDataFrame([(-60.0, 20.2, 1), (10.2, 25.2, 1)], "lat double, lon double, code int"))
    left = {(r["lat"], r["_id"]) for r in spatial._not_farther(seen).collect()}
    assert {(-60.0, 40), (10.2, 50)} <= left and len(left) < 25  # of 200


def test_edges_are_as_near_as_brute_force_says(spark):
    rng = random.Random(3)
    shapes = {}
    for code in range(12):
        x, y, r = rng.uniform(-150, 150), rng.uniform(-70, 70), rng.uniform(0.4, 6)
        turn = sorted(rng.uniform(0, 2 * np.pi) for _ in range(7))
        shapes[code] = [(float(x + r * np.cos(t)), float(y + r * np.sin(t))) for t in turn]
    shapes[12] = shapes[11]  # the same: ties go to the smaller code
    at = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(40)] + [(y, x) for x, y in (s[0] for s in shapes.values())]
    places = [(i, *at[i % len(at)]) for i in range(3 * len(at))] + [(0, -80.0, -170.0), (999, None, 1.0)]
    points = spark.createDataFrame(places, "pgid int, lat double, lon double")
    table = spark.createDataFrame([(c, [tuple(map(float, p)) for p in s]) for c, s in shapes.items()], "code int, ring array<struct<x:double,y:double>>")
    got = {r["pgid"]: (r["code"], r["distance"]) for r in spatial.nearest_polygon(points, table, measure="edge").collect()}
    best = {}
    for i, lat, lon in places[:-1]:
        best[i] = min(best.get(i, (np.inf, 0)), *((rings.distance([np.array(s, float)], lon, lat), c) for c, s in shapes.items()))
    assert got.keys() == best.keys()
    for i, (distance, code) in best.items():
        assert abs(got[i][1] - distance) < 1e-6 and (got[i][0] == code or abs(rings.distance([np.array(shapes[got[i][0]], float)], *reversed(at[i % len(at)])) - distance) < 1e-6)
    assert 12 not in {c for c, _ in got.values()}
