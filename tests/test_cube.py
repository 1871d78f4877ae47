"""Cubes of blocks: round trips, blocks that are not opened, writes that fail."""

from __future__ import annotations

import os
import random

import pytest
from gridloom.functions import axes
from gridloom.sources import cube, ledger
from pyspark.sql import functions as F

SCHEMA = "month_id int, pgid int, a double, b double"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    at = {(rng.randrange(470, 520), rng.choice([1, 720, 259_200, 127_874, rng.randrange(1, 259_201)])) for _ in range(900)}
    return [(m, p, rng.choice([None, 0.0, float(rng.randrange(-50, 1000))]), rng.choice([None, float("nan"), rng.random()])) for m, p in sorted(at)]


@pytest.fixture
def made(spark, rows, tmp_path):
    path = str(tmp_path / "cube")
    cube.write(spark.createDataFrame(rows, SCHEMA), path, ["a", "b"], {"a": "extensive"})
    return cube.Cube(spark, path)


def plain(rows, keep):
    out = [(m, p, a, None if b is None or b != b else pytest.approx(b, rel=1e-6)) for m, p, a, b in rows]
    return sorted((r for r in out if (r[2] is not None or r[3] is not None) and keep(*r[:2])), key=lambda r: r[:2])


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: r[:2])


def test_all_rows_come_back(made, rows):
    assert got(made.load(["a", "b"])) == plain(rows, lambda m, p: True)
    small = cube.Layout(5, 7)
    assert small.months == 5
    first = min(m for m, _, a, _ in rows if a)
    assert made.meta["features"]["a"] == {"type": "extensive", "first_month": first, "last_month": max(m for m, _, a, _ in rows if a)}
    totals = {r["feature"]: (r["n"], r["total"], r["least"], r["greatest"]) for r in made.totals().collect()}
    values = [a for *_, a, _ in rows if a is not None]
    assert totals["a"] == (len(values), sum(values), min(values), max(values))


@pytest.mark.parametrize("layout", [cube.Layout(5, 7), cube.Layout(1, 360), cube.Layout(24, 1)])
def test_layouts(spark, rows, tmp_path, layout):
    cube.write(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "c"), ["b", "a"], layout=layout)
    assert got(cube.Cube(spark, str(tmp_path / "c")).load(["a", "b"])) == plain(rows, lambda m, p: True)


def test_only_blocks_that_are_met_are_opened(spark, made, rows):
    every = made.load(["a"]).inputFiles()
    cells = [127_874, 127_875]
    region = spark.createDataFrame([(c,) for c in cells * 2], "pgid int")
    part = made.load(["a", "b"], region, 481, 492)
    assert got(part) == plain(rows, lambda m, p: p in cells and 481 <= m <= 492)
    band = (127_874 - 1) // 720 // 32
    opened = [f for f in part.inputFiles() if "/blocks/" in f]
    assert len(opened) == 1 and f"block=40/band={band}/" in opened[0] and len([f for f in every if "/blocks/" in f]) > 20
    high = made.load(["b"], above={"a": 990})
    assert sorted((m, p) for m, p, _ in got(high)) == [(m, p) for m, p, a, b in rows if a is not None and a > 990 and b is not None and b == b]
    met = {f.rsplit("/", 1)[0] for f in high.inputFiles() if "/blocks/" in f}
    assert met == {f"{_uri(made.folder)}/blocks/block={(m - 1) // 12}/band={(p - 1) // 720 // 32}" for m, p, a, _ in rows if a is not None and a > 990 and _has_b(rows, m, p)}
    assert made.load(["a"], above={"a": 5000}).count() == 0 and made.load(["a"], region.limit(0)).count() == 0
    read = made.load(["b"])._jdf.queryExecution().optimizedPlan().toString()
    assert "a#" not in read.split("Relation", 1)[0].replace("at#", "")  # feature a is no column of the scan


def _uri(path):
    return "file://" + path


def _has_b(rows, month, pgid):
    """Whether the block of a row has any value of b."""
    key = lambda m, p: ((m - 1) // 12, (p - 1) // 720 // 32, (p - 1) % 720 // 32)
    return any(key(m, p) == key(month, pgid) and b is not None and b == b for m, p, _, b in rows)


def test_a_failed_write_leaves_the_old_cube(spark, made, rows, monkeypatch):
    before, version = got(made.load(["a", "b"])), made.version
    other = spark.createDataFrame(rows, SCHEMA).withColumn("a", F.col("a") + 1)
    fails = {
        "there twice": other.unionByName(other.limit(1)),
        "off the grid": other.unionByName(spark.createDataFrame([(500, 259_201, 1.0, 1.0)], SCHEMA)),
        "without month": other.unionByName(spark.createDataFrame([(None, 5, 1.0, 1.0)], SCHEMA)),
    }
    for what, table in fails.items():
        with pytest.raises(Exception, match=what):
            cube.write(table, made.path, ["a", "b"])
    real = cube._zones
    monkeypatch.setattr(cube, "_zones", lambda *a: real(*a).withColumn("total", F.col("total") + 1))
    with pytest.raises(cube.SumsDiffer, match="a: .* given"):
        cube.write(other, made.path, ["a", "b"])
    monkeypatch.undo()
    again = cube.Cube(spark, made.path)
    assert again.version == version and got(again.load(["a", "b"])) == before
    assert sorted(n for n in os.listdir(made.path) if not n.startswith(".")) == sorted(["CURRENT", version])


def test_versions_are_swapped_and_old_readers_go_on(spark, made, rows, tmp_path):
    old = made.load(["a"])
    path = str(tmp_path / "ledger")
    version = cube.write(spark.createDataFrame(rows[:10], SCHEMA), made.path, ["a", "b"], ledger=path)
    assert old.count() == sum(a is not None for *_, a, _ in rows)
    assert got(cube.Cube(spark, made.path).load(["a", "b"])) == plain(rows[:10], lambda m, p: True)
    row = ledger.read(spark, path).head()
    assert (row["version"], row["outcome"], row["n_events"]) == (version, "success", 10) and len(row["content_digest"]) == 16
    assert cube.vacuum(spark, made.path) == [made.version]
    with pytest.raises(FileNotFoundError):
        cube.Cube(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="unknown"):
        cube.Cube(spark, made.path).load(["c"])


def test_empty_cube_and_other_grids(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    cube.write(none, str(tmp_path / "none"), ["a"])
    assert cube.Cube(spark, str(tmp_path / "none")).load(["a"]).count() == 0
    coarse = axes.GridConfig(90.0)
    table = spark.createDataFrame([(m, p, float(p), 1.0) for m in (1, 24) for p in range(1, 9)], SCHEMA)
    cube.write(table, str(tmp_path / "coarse"), ["a"], grid=coarse, layout=cube.Layout(12, 3))
    assert got(cube.Cube(spark, str(tmp_path / "coarse")).load(["a"])) == sorted((m, p, float(p)) for m in (1, 24) for p in range(1, 9))


def test_frames_go_back_to_the_grid(spark):
    frame = spark.createDataFrame([(541, 149_426, [1.0, 10.0]), (1, 5, [2.0, 20.0]), (541, 0, [3.0, 30.0]), (541, None, [4.0, 40.0])], "time int, unit int, features array<float>")
    found = [tuple(r) for r in cube.from_feature_frame(frame, ["a", "b"], 541, 542).collect()]
    assert found == [(541, 149_426, 1.0, 10.0, True), (1, 5, 2.0, 20.0, False), (541, 0, 3.0, 30.0, False), (541, None, 4.0, 40.0, False)]
    with pytest.raises(Exception, match="as many features"):
        cube.from_feature_frame(frame, ["a"], 541, 542).collect()
