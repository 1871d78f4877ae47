"""Hard negatives against brute force, with small shards and many copies; bounds of trees."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from gridloom.llm import queries as q
from gridloom.llm import vantage_tree as vt
from pyspark.sql import functions as F

ROWS = "vec_id long, label long, v array<long>"


def plain(rows, anchors, positives=5, k=3, low=50, high=95):
    """Rows and anchors as (vec_id, label, v)."""
    out = []
    one = {}
    for i, label, v in sorted(anchors):
        one.setdefault(i, (label, v))
    for anchor, (label, v) in one.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i, other) for i, other, w in rows if i != anchor)
        best = [(i, -s) for s, i, other in scored if other == label][:positives]
        for positive, ps in best:
            fits = [(i, -s) for s, i, other in scored if other != label and low * ps <= -100 * s <= high * ps]
            out += [(anchor, positive, r + 1, i, ps, s) for r, (i, s) in enumerate(fits[:k])]
    return sorted(out)


def mined(spark, rows, anchors, **how):
    table = lambda r: spark.createDataFrame(r, ROWS)
    found = vt.hard_negatives(table(rows), table(anchors), **how)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("shape", ["random", "clusters", "copies", "norms", "huge"])
def test_equals_brute_force(spark, monkeypatch, shape):
    rng = random.Random(len(shape))
    monkeypatch.setattr(vt, "LEAF_ROWS", 8)
    n, width = 600, 6
    vectors = [[rng.randrange(-90, 90) for _ in range(width)] for _ in range(n)]
    if shape == "clusters":
        centres = [[rng.randrange(-300, 300) for _ in range(width)] for _ in range(6)]
        vectors = [[c + rng.randrange(-9, 9) for c in centres[i % 6]] for i in range(n)]
    if shape == "copies":
        vectors = [vectors[0] if i % 3 else v for i, v in enumerate(vectors)]
    if shape == "norms":
        vectors = [[c * (1 + i % 40) for c in v][: 3 + i % 4] for i, v in enumerate(vectors)]
    if shape == "huge":
        vectors = [[c * 10**7 for c in v] for v in vectors]
    rows = [(i, i % 4 if shape != "clusters" else i % 6, v) for i, v in enumerate(vectors)]
    anchors = [r for r in rows if r[0] % 17 == 0]
    monkeypatch.setattr(vt, "SAMPLE", 200)
    assert mined(spark, rows, anchors, shard_rows=60, anchor_rows=10) == plain(rows, anchors)


def test_shards_are_small_and_all_rows_are_there(spark):
    rows = [(i, 0, [7, 7] if i % 3 else [i, -i]) for i in range(9000)]
    index = vt.Index(spark.createDataFrame(rows, ROWS), shard_rows=2048)
    sizes = [r["count"] for r in index.rows.groupBy("shard").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 2048 + 64 and len(sizes) == index.n_shards


def test_bounds_hold_and_leaves_cover_all(spark):
    rng = np.random.default_rng(1)
    points = np.r_[rng.normal(size=(500, 5)), np.ones((300, 5))]
    queries = rng.normal(size=(20, 5))
    tree = vt.Tree(points, 16)
    assert sorted(tree.order) == list(range(800)) and tree.cuts[0] == 0 and tree.cuts[-1] == 800
    least, most = tree.leaf_bounds(queries)
    distance = np.sqrt(((queries[:, None] - points[None]) ** 2).sum(2))
    for leaf, (a, b) in enumerate(zip(tree.cuts[:-1], tree.cuts[1:])):
        own = distance[:, tree.order[a:b]]
        assert (least[:, leaf, None] <= own + 1e-6).all() and (most[:, leaf, None] >= own - 1e-6).all()
    other = rng.normal(size=(400, 5))
    least, most = tree.leaf_bounds(queries, whole=True)
    distance = np.sqrt(((queries[:, None] - other[None]) ** 2).sum(2))
    leaf = tree.route(other)
    assert (least[:, leaf] <= distance + 1e-6).all() and (most[:, leaf] >= distance - 1e-6).all()


def test_clustered_anchors_pass_regions_over(spark):
    rng = random.Random(4)
    rows = [(i, i % 2, [round(1000 * f(i % 8 * math.pi / 4)) + rng.randrange(-5, 5) for f in (math.cos, math.sin)]) for i in range(800)]
    index = vt.Index(spark.createDataFrame(rows, ROWS), shard_rows=100)
    window = F.array(F.struct(F.lit(0).cast("long").alias("no"), F.lit(900_000).cast("long").alias("low"), F.lit(None).cast("long").alias("high"), F.lit(None).cast("long").alias("floor")))
    asked = spark.createDataFrame(rows[:16], ROWS).withColumn("windows", window)
    visits = [len(r[0]) for r in asked.select(index._regions_to_search(F.col("v"), F.col("windows"))).collect()]
    assert 2**index.tree.depth >= 8 and sum(visits) < 4 * len(visits)


def test_query_with_nulls_ties_and_repeats(spark, tmp_path):
    rng = random.Random(8)
    some = lambda: [rng.choice([-1.0, -0.25, 0.0, 0.004, 0.5, 1.0]) for _ in range(3)]
    rows = [(i, some(), rng.choice([0, 1, 2, None])) for i in range(-60, 160)]
    rows += [(201, None, 1), (202, [1.0, None, 0.0], 1), (203, [float("nan"), 1.0, 1.0], 1), (250, [float("inf"), 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0], 0), (300, [], 1), (350, [0.0, 0.0, 0.0], 1)]
    rows += [rows[3]] * 2 + [(100, [0.5, 0.5, 0.5], 9)]
    table = spark.createDataFrame([(*r, "clash", 3) for r in rows], "vec_id long, embedding array<float>, label int, v string, score int")
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    kept = []
    for i, e, label in rows:
        if i is not None and label is not None and e is not None and all(c is not None and math.isfinite(c) for c in e):
            kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(c))) for c in e] + [0] * (3 - len(e))))
    found = q.op11_vantage_tree(spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == plain(kept, [r for r in kept if r[0] % 50 == 0])
    assert q.op11_vantage_tree(spark, str(tmp_path)).dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]


def test_empty_tables(spark):
    none = spark.createDataFrame([], ROWS)
    some = spark.createDataFrame([(0, 1, [1, 2]), (1, 1, [2, 2]), (2, 2, [1, 1])], ROWS)
    for rows, anchors in ((none, none), (none, some), (some, none)):
        assert vt.hard_negatives(rows, anchors).count() == 0
    assert [tuple(r) for r in vt.hard_negatives(some, some.where("vec_id = 0")).collect()] == [(0, 1, 1, 2, 6, 3)]
