"""Boundaries and failures of the operators, on planted rows."""

from __future__ import annotations

import datetime as dt
import json
import re
import zipfile
from pathlib import Path

import numpy as np
import pytest
from gridloom.functions import axes, rings, versions
from gridloom.operators import analytics, assemble, conserve, expand, gridagg, interp, quality, query, resolve, spatial, store
from gridloom.plans import registry
from gridloom.sources import ledger, snapshots
from gridloom.streaming import consolidate
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = dt.date


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---------------------------------------------------------------- axes


@pytest.mark.parametrize(
    "lat,lon,pgid",
    [(-90.0, -180.0, 1), (4.0, 31.5, 135784), (89.99, 179.99, 259200), (90.0, 0.0, None), (0.0, 180.0, None), (float("nan"), 0.0, None), (None, 0.0, None), (-90.01, 0.0, None), (0.0, 0.0, 129961)],
)
def test_cell_of_a_point(spark, lat, lon, pgid):
    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    assert df.select(axes.latlon_to_pgid(F.col("lat"), F.col("lon"))).head()[0] == pgid


def test_cells_and_their_centres(spark):
    cells = axes.cells(spark)
    assert cells.count() == 259_200
    back = cells.where(axes.latlon_to_pgid(F.col("lat"), F.col("lon")) != F.col("pgid"))
    assert back.count() == 0
    with pytest.raises(ValueError):
        axes.GridConfig(0.7)


def test_months(spark):
    df = spark.createDataFrame([("2024-01-31",), ("2024-13-01",), ("2024-1-01",), ("2024-02-99",), (None,), ("1979-12-01",)], "d string")
    assert [r[0] for r in df.select(axes.month_id_from_text(F.col("d"))).collect()] == [529, None, None, 530, None, 0]
    assert spark.range(1).select(axes.month_start(F.lit(481))).head()[0] == DAY(2020, 1, 1)
    assert axes.parse_time_range("1996", "1996", 1, 999) == (193, 204)
    assert axes.parse_time_range(None, "1996-02-11", 100, 999) == (100, 194)
    for bad in (("1996-13", None), ("x", None), ("1997", "1996"), (1000, 1001)):
        with pytest.raises(ValueError):
            axes.parse_time_range(*bad, 1, 999)


def test_versions(spark):
    df = spark.createDataFrame([("25.9.11",), ("25.10",), ("x.1",), (None,)], "v string")
    assert [r[0] for r in df.select(versions.version_key(F.col("v"))).collect()] == [[25, 9, 11], [25, 10], [0], [0]]
    paths = spark.createDataFrame([("/a/ged_v25.1_1989_2024.parquet",), ("/a/ged_candidate_25.0.12.parquet",)], "p string")
    assert [r[0] for r in paths.select(versions.version_from_path(F.col("p"), "annual")).collect()] == ["25.1", None]
    assert spark.range(1).select(versions.candidate_versions(F.lit(2025), "dot9")).head()[0][:2] == ["25.9.1", "25.9.2"]


# ---------------------------------------------------------------- store and resolution

EVENT = "id long, _source_type string, _source_version string, date_end date, best long"


def test_vintages_keep_null_keys_apart_from_absent_ones(spark):
    have = spark.createDataFrame([(1, None), (2, "a")], "id long, v string")
    batch = spark.createDataFrame([(1, None), (2, "b"), (2, "b"), (None, "a")], "id long, v string")
    assert rows(store.new_vintages(batch, have, ("id", "v")), "id", "v") == [(None, "a"), (2, "b"), (2, "b")]


def test_append_promotes_absent_columns_and_refuses_other_types(spark):
    a, b = spark.createDataFrame([(1, "x")], "id long, a string"), spark.createDataFrame([(2, 3)], "id long, b long")
    assert rows(store.append(a, b), "id") == [(1, "x", None), (2, None, 3)]
    with pytest.raises(ValueError):
        store.append(a, spark.createDataFrame([(2, 3)], "id long, a long"))


def test_upsert_replaces_only_with_later_rows(spark):
    s = "id long, t string, v string"
    old = spark.createDataFrame([(1, "2", "old"), (2, "2", "old"), (3, None, "old"), (4, "1", "old")], s)
    new = spark.createDataFrame([(1, "1", "new"), (2, "3", "new"), (3, "1", "new"), (5, None, "new"), (4, None, "new")], s)
    assert rows(store.upsert_latest(old, new, "id", "t").select("id", "v"), "id") == [(1, "old"), (2, "new"), (3, "new"), (4, "old"), (5, "new")]


def test_survivors_and_stale_rows(spark):
    df = spark.createDataFrame(
        [
            (1, "annual", "25.1", DAY(2024, 12, 1), 1), (1, "candidate", "25.0.12", DAY(2024, 12, 1), 2), (1, "dot9", "25.9.2", DAY(2024, 12, 1), 3),
            (2, "candidate", "25.0.9", DAY(2025, 1, 1), 4), (2, "candidate", "25.0.11", DAY(2025, 1, 1), 5), (3, "candidate", "25.0.1", DAY(2024, 1, 1), 6),
            (4, "dot9", "25.9.1", DAY(2025, 1, 1), 7), (1, "candidate", "25.0.1", None, 8), (5, "dot9", "25.9.2", DAY(2025, 2, 1), 9),
        ],
        EVENT,
    )
    assert rows(resolve.survivors(df.where("id < 3"), "annual_wins").select("id", "best"), "id") == [(1, 1), (2, 5)]
    assert rows(resolve.survivors(df.where("id < 3"), "dot9_wins").select("id", "best"), "id") == [(1, 3), (2, 5)]
    assert [r[0] for r in rows(resolve.drop_stale(df).select("best"), "best")] == [1, 2, 3, 4, 5, 9]
    assert 8 in [r[0] for r in rows(resolve.drop_stale(df, kleene=True).select("best"))]
    with pytest.raises(KeyError):
        resolve.survivors(df, "none")


def test_row_filter_lets_null_types_pass(spark):
    df = spark.createDataFrame([(1, None, 4), (0, 1, 1), (None, 1, 1), (2, 4, 1), (3, 1, 6), (4, 2, None)], "priogrid_gid long, type_of_violence int, where_prec int")
    assert [r[0] for r in rows(df.where(resolve.passes(1, 3, (6,))), "priogrid_gid")] == [1, 4]
    assert [r[0] for r in rows(df.where(resolve.passes(1, 3, (6,), F.lit(True))), "priogrid_gid")] == [1, 3, 4]


# ---------------------------------------------------------------- expansion


def summary(spark, best, start, end, prec=5, source="candidate"):
    return spark.createDataFrame([(1, best, best, best, start, end, prec, source)], "id long, best long, low long, high long, date_start date, date_end date, date_prec int, _source_type string")


@pytest.mark.parametrize(
    "rule,best,expected",
    [("date_end_only", 7, [(3, 7.0)]), ("even_split", 6, [(1, 2.0), (2, 2.0), (3, 2.0)]), ("ceil_split", 7, [(1, 3.0), (2, 3.0), (3, 3.0)]), ("floor_split", 7, [(1, 2.0), (2, 2.0), (3, 2.0)]), ("ceil_split", 2, [(3, 2.0)]), ("ceil_split", 0, [(3, 0.0)])],
)
def test_month_splits(spark, rule, best, expected):
    out = expand.split_months(summary(spark, best, DAY(2024, 1, 31), DAY(2024, 3, 1)), rule)
    assert rows(out.select(F.month("date_month"), "best"), "date_month") == expected


def test_split_by_source_and_bad_dates(spark):
    e = summary(spark, 9, DAY(2024, 1, 1), DAY(2024, 3, 1), source="annual")
    assert expand.split_months(e, "ceil_split", by_source={"annual": "date_end_only"}).count() == 1
    assert expand.split_months(summary(spark, 9, None, None), "ceil_split").count() == 0
    assert expand.split_months(summary(spark, 9, DAY(2024, 5, 1), DAY(2024, 3, 1)), "ceil_split").count() == 1
    with pytest.raises(KeyError):
        expand.split_months(e, "other")


def test_allocation_is_exact(spark):
    df = spark.createDataFrame([(1, 17, 100, 0.5), (1, 17, 101, 0.3), (1, 17, 102, 0.2), (2, 1, 5, 0.5), (2, 1, 4, 0.5)], "r int, v long, pgid int, share double")
    got = rows(df.select("r", "pgid", expand.allocate(df, "v", "share", ["r"], F.col("pgid")).alias("a")), "r", "pgid")
    assert got == [(1, 100, 9), (1, 101, 5), (1, 102, 3), (2, 4, 1), (2, 5, 0)]


def test_distribution_conserves_and_passes_through(spark):
    codes = spark.createDataFrame([(100, 10), (101, 10), (102, 10), (200, 20)], "pgid int, code int")
    s = "id int, where_prec int, priogrid_gid int, best long, low long, high long"
    known = spark.createDataFrame([(1, 1, 100, 50, 0, 0), (2, 2, 101, 30, 0, 0), (3, 3, 102, 20, 0, 0)], s)
    weights = expand.weight_map(known, codes)
    assert rows(weights, "code", "pgid") == [(10, 100, 0.5), (10, 101, 0.3), (10, 102, 0.2), (20, 200, 1.0)]
    vague = spark.createDataFrame([(4, 4, 100, 17, 3, 101), (5, 6, 999, 8, 8, 8), (6, 1, 100, 5, 5, 5), (7, 5, None, 2, 2, 2), (8, 5, 200, 4, 4, 4)], s)
    out = expand.distribute(vague, weights, codes)
    assert rows(out.groupBy("id").agg(F.sum("best"), F.sum("low"), F.sum("high"), F.count("*")), "id") == [(4, 17, 3, 101, 3), (5, 8, 8, 8, 1), (6, 5, 5, 5, 1), (7, 2, 2, 2, 1), (8, 4, 4, 4, 1)]
    assert [r[0] for r in rows(out.where("_spatial_distributed").select("id").distinct(), "id")] == [4, 8]


def test_undated_and_reversed_events_are_counted_or_refused(spark):
    good, bad = summary(spark, 9, DAY(2024, 1, 1), DAY(2024, 3, 1)), summary(spark, 9, DAY(2024, 5, 1), DAY(2024, 3, 1))
    with pytest.raises(Exception, match="ends before it begins"):
        expand.split_months(bad, "even_split").collect()
    assert rows(expand.date_accounting(good.unionByName(bad).unionByName(summary(spark, 9, None, None)))) == [(3, 1, 1, 1)]


def test_two_levels_and_their_annotations(spark):
    codes = spark.createDataFrame([(100, 10, 1), (101, 10, 1), (100, 1, 0), (101, 1, 0), (102, 1, 0), (103, 1, 0)], "pgid int, code int, level int")
    s = "id int, where_prec int, priogrid_gid int, best double, low double, high double"
    known = spark.createDataFrame([(1, 1, 100, 3.0, 0.0, 0.0), (2, 1, 103, 1.0, 0.0, 0.0)], s)
    vague = spark.createDataFrame([(4, 5, 101, 7.9, 1.0, None), (5, 6, 101, 10.0, 0.0, 3.0), (6, 4, 102, 2.5, 2.0, 2.0), (7, 3, 100, 2.5, 2.0, 2.0)], s)
    out = expand.distribute(vague, expand.weight_map(known, codes), codes)
    got = rows(out.select("id", "priogrid_gid", "best", "high", "_spatial_distributed", "_spatial_source_pgid", "_spatial_polygon_code", "_spatial_n_cells"), "id", "priogrid_gid")
    assert got == [
        (4, 100, 7.0, 0.0, True, 101, 10, 1),
        (5, 100, 8.0, 3.0, True, 101, 1, 2),
        (5, 103, 2.0, 0.0, True, 101, 1, 2),
        (6, 102, 2.5, 2.0, False, None, None, None),
        (7, 100, 2.5, 2.0, False, None, None, None),
    ]
    assert set(out.columns) - set(vague.columns) == {"_spatial_distributed", "_spatial_share", "_spatial_source_pgid", "_spatial_polygon_code", "_spatial_n_cells"}


def test_interpolation_before_between_and_after(spark):
    months = axes.months_between(spark, 241, 300)  # 2000 to 2004
    v = spark.createDataFrame([("a", 2001, 12.0), ("a", 2003, 36.0)], "key string, year int, value double")
    line = dict((m, x) for _, m, x in rows(interp.linear(v, months, "key", "value")))
    assert len(line) == 60 and line[252] == 0 and line[253] == 12 and line[265] == 24 and line[277] == 36 and line[300] == 36
    stairs = dict((m, x) for _, m, x in rows(interp.step(v.select("key", ((F.col("year") - 1980) * 12 + 1).alias("month_id"), "value"), months, "key", "value")))
    assert len(stairs) == 60 and stairs[252] == 0 and stairs[276] == 12 and stairs[277] == 36


# ---------------------------------------------------------------- grid


def test_known_answers_on_the_grid(spark):
    df = spark.createDataFrame([(1, -45.0, -90.0, "2024-01-15", 10, 1), (2, -45.0, -90.0, "2024-01-20", None, 1), (3, 45.0, -90.0, "2024-03-10", 20, 2), (4, 90.0, 0.0, "2024-01-01", 1, 1), (5, 0.0, 0.0, "bad", 1, 1)], "id int, latitude double, longitude double, day string, best long, type_of_violence int")
    placed = gridagg.place(df, 529, 540, axes.month_id_from_text(F.col("day")))
    assert rows(gridagg.accounting(placed)) == [(5, 3, 1, 1)]
    out = gridagg.compile_grid(placed, registry.CONFLICT_FEATURES)
    assert [(r["month_id"], r["ged_sb_count"], r["ged_sb_best"], r["ged_ns_count"], r["ged_ns_best"]) for r in out.orderBy("month_id").collect()] == [(529, 2, 10, 0, 0), (531, 0, 0, 1, 20)]
    with pytest.raises(ValueError):
        gridagg.compile_grid(placed, [gridagg.FeatureSpec("x", "sum_field", "absent")])
    with pytest.raises(ValueError):
        gridagg.FeatureSpec("x", "median", "best")


def test_raster_blocks_face_north(spark):
    px = spark.createDataFrame([(0, 0, 1.0), (59, 59, 2.0), (60, 0, 4.0), (0, 60, -200.0)], "row int, col int, value double")
    assert rows(gridagg.raster_blocks(px, 60, nodata=-200), "block_row", "block_col") == [(0, 0, 3.0), (0, 1, 0.0), (1, 0, 4.0)]
    assert spark.range(1).select(gridagg.raster_block_to_pgid(F.lit(0), F.lit(0))).head()[0] == 359 * 720 + 1


def test_assembly_fills_and_boundaries(spark):
    axis = axes.spine(axes.months_between(spark, 1, 2), spark.createDataFrame([(1,), (2,)], "pgid int"))
    a = spark.createDataFrame([(1, 1, 7)], "month_id int, pgid int, a int")
    b = spark.createDataFrame([(1, 5)], "pgid int, code int")
    assert rows(assemble.stack(axis, [a], [b], {"code": -1}), "month_id", "pgid") == [(1, 1, 7, 5), (1, 2, 0, -1), (2, 1, 0, 5), (2, 2, 0, -1)]
    assert rows(assemble.boundaries(a, ["a"])) == [("a", 1, 1)]
    with pytest.raises(ValueError):
        assemble.stack(axis, [a, a])


def test_query_formats_and_errors(spark):
    t = spark.createDataFrame([(1, 10, 1, 2.0, 0.0), (1, 11, 0, 5.0, 1.0), (2, 10, 1, float("nan"), 0.0), (3, 10, 1, 0.0, 0.0)], "month_id int, pgid int, country_id int, a double, b double")
    regions = spark.createDataFrame([("North", 10), ("South", 11)], "region string, pgid int")
    assert query.load(t, ["b", "a"], query.region_cells(regions, ["north"]), 1, 2, (1, 3)).columns == ["month_id", "pgid", "b", "a"]
    assert rows(query.load(t, ["a"], None, 1, 2, (1, 3), "country_month"), "month_id") == [(1, 1, 2.0), (2, 1, 0.0)]
    assert query.load(t, ["a", "b"], axis=(1, 3), sparse=True).count() == 3
    assert query.load(t, ["a", "b"], axis=(1, 3), output="feature_frame").where("time = 1 and unit = 11").head()["features"] == [5.0, 1.0]
    assert query.pre_coverage({"a": 5, "b": 1}, 3) == ["a"]
    for bad in (lambda: query.load(t, ["x"]), lambda: query.load(t, ["a", "a"]), lambda: query.load(t, ["a"], output="x"), lambda: query.region_cells(regions, ["east"]), lambda: query.country_month(t, ["a"], {"a": "intensive"})):
        with pytest.raises(ValueError):
            bad()


def test_conservation_and_reconciliation(spark):
    t = spark.createDataFrame([("x", "x1", 1.0), ("x", "x2", 2.0), ("y", "y1", 3.0)], "l0 string, l1 string, v double")
    conserve.assert_conserved(t, ["v"], F.col("l0") == "x")
    conserve.assert_reconciled(t, ["l0", "l1"], "v")
    with pytest.raises(ValueError):
        conserve.assert_reconciled(t.union(spark.createDataFrame([("y", "x1", 1.0)], t.schema)), ["l0", "l1"], "v")


def test_quality_rules_and_diff(spark):
    t = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    assert dict(rows(quality.violations(t, {"positive": F.col("v") > 0, "id": F.col("id") > 0}))) == {"positive": 2, "id": 0}
    new = spark.createDataFrame([(1, 6), (2, 0), (4, 1)], "id int, v int")
    assert rows(quality.snapshot_diff(t, new, "id", "v"), "id") == [(1, "revised", 1), (3, "removed", 1), (4, "added", 1)]
    with pytest.raises(ValueError):
        quality.assert_schema(t, {"v": "string"})
    a, b = quality.content_digest(t, "id", "v"), quality.content_digest(t.orderBy(F.desc("id")), "id", "v")
    assert rows(a) == rows(b)


def test_analytics_by_hand(spark):
    t = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 4.0), ("a", 5, 4.0), ("b", 1, 0.0)], "u string, month_id int, v double")
    assert rows(analytics.largest_jump(t, "u", "v")) == [("a", 2, 3.0)]
    assert rows(analytics.empty_months(t, "u", "v"), "month_id") == [("a", 3), ("a", 4)]
    assert rows(analytics.persistence(t, "u", "v"), "u") == [("a", 100.0), ("b", 0.0)]
    same = spark.createDataFrame([("g", i, 1.0) for i in range(4)], "g string, u int, v double")
    assert rows(analytics.gini(same, "g", "u", "v"))[0][1] == pytest.approx(1 - 2 * (2.5 - 0.625) / 4)


def test_polygons(spark):
    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    shapes = spark.createDataFrame(
        [(2, ring((0, 0), (1, 0), (1, 1), (0, 1))), (1, ring((1, 0), (1.7, 0), (1.7, 0.5), (1, 0.5))), (3, ring((10, 10), (12, 10), (10, 12)))],
        "code int, ring array<struct<x:double,y:double>>",
    )
    got = {r["pgid"]: (r["code"], round(r["area"], 4)) for r in spatial.area_majority_join(shapes).collect()}
    base = 180 * 720 + 360 + 1
    assert got[base] == (2, 0.25) and got[base + 2] == (1, 0.25) and got[base + 3] == (1, 0.1)
    inside = {r["pgid"] for r in spatial.centroid_join(shapes.where("code = 3")).collect()}
    assert len(inside) == 6 and (200 * 720 + 380 + 1) in inside
    points = spark.createDataFrame([(1, 0.4, 0.4), (2, 11.0, 11.0)], "pgid int, lat double, lon double")
    assert rows(spatial.nearest_polygon(points, shapes).select("pgid", "code"), "pgid") == [(1, 2), (2, 3)]


# ---------------------------------------------------------------- sources, streams, registries


def test_store_files(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    assert snapshots.read_store(spark, path) is None
    snapshots.write_store(spark.range(3), path)
    snapshots.write_store(snapshots.read_store(spark, path).union(spark.range(2)), path)
    assert snapshots.read_store(spark, path).count() == 5 and len(list(tmp_path.iterdir())) == 1
    with pytest.raises(ValueError):
        snapshots.read_columns(spark, path, ["absent"])
    moved = snapshots.archive(spark, path, "20240101")
    assert moved.endswith("archive/store_20240101") and not snapshots.exists(spark, path)


def test_landed_formats(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"Result": [{"id": 1, "best": 2}, {"id": 2}], "TotalPages": 1}))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("best", T.LongType())])
    assert rows(snapshots.read_pages(spark, str(tmp_path / "p.json"), schema), "id") == [(1, 2), (2, None)]
    (tmp_path / "c.csv").write_text("a,b,c\n1,2,3\n")
    assert rows(snapshots.read_csv(spark, str(tmp_path / "c.csv"), ["c", "a"])) == [(3, 1)]
    square = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    shapes = {"features": [{"properties": {"code": 1}, "geometry": {"type": "Polygon", "coordinates": square}}, {"properties": {"code": 2}, "geometry": {"type": "MultiPolygon", "coordinates": [square, square]}}, {"properties": {"code": 3}, "geometry": None}]}
    (tmp_path / "g.json").write_text(json.dumps(shapes))
    got = snapshots.read_geojson(spark, str(tmp_path / "g.json"), T.StructType([T.StructField("code", T.IntegerType())]))
    assert [r["code"] for r in got.orderBy("code").collect()] == [1, 2, 2] and got.head()["ring"][1]["x"] == 1.0
    (tmp_path / "l.jsonl").write_text('{"dataset": "d", "version": "25.1", "outcome": "success", "content_digest": "aa", "timestamp": "2024-01-01"}\nnot json\n{"dataset": "d", "version": "25.1", "outcome": "failed", "content_digest": "bb", "timestamp": "2024-02-01"}\n')
    led = ledger.read(spark, str(tmp_path / "l.jsonl"))
    assert led.count() == 2 and rows(store.harvest_index(led)) == [("25.1", "aa", "2024-01-01")]
    assert quality.last_ledger_rows(led, 1).head()["outcome"] == "failed"
    snapshots.write_cube(spark.createDataFrame([(481, 1, 2.0), (492, 1, 3.0), (493, 1, 4.0)], "month_id int, pgid int, a double"), str(tmp_path / "cube"))
    assert sorted(p.name for p in (tmp_path / "cube").glob("year=*")) == ["year=2020", "year=2021"]
    late = query.load(spark.read.parquet(str(tmp_path / "cube")), ["a"], start="2021-01")
    assert rows(late) == [(493, 1, 4.0)]
    assert "year" in re.search(r"PartitionFilters: \[(.*?)\]", late._jdf.queryExecution().executedPlan().toString())[1]


def test_a_store_comes_back_if_the_new_one_cannot_be_moved(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/store"
    snapshots.write_store(spark.range(3), path)
    real = snapshots._path

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            return ".new-" not in a.getName() and self.fs.rename(a, b)

    monkeypatch.setattr(snapshots, "_path", lambda s, p: (real(s, p)[0], Broken(real(s, p)[1])))
    with pytest.raises(OSError):
        snapshots.write_store(spark.range(9), path)
    monkeypatch.undo()
    assert snapshots.read_store(spark, path).count() == 3


def test_monthly_counts_are_by_month(spark, tmp_path):
    e = spark.createDataFrame([(1, "a", "2024-01-31 10:00:00"), (2, "a", "2024-01-02 10:00:00"), (1, "a", "2024-01-31 10:00:00"), (3, "a", "2024-02-01 00:00:00")], "id int, event_type string, t string")
    e = e.select("id", "event_type", F.to_timestamp("t").alias("ts"))
    e.write.parquet(f"{tmp_path}/in")
    stream = consolidate.monthly_counts(spark.readStream.schema(e.schema).parquet(f"{tmp_path}/in"), "ts", "id")
    stream.writeStream.format("memory").queryName("months").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(120)
    assert rows(spark.table("months"), "month") == [(DAY(2024, 1, 1), "a", 2), (DAY(2024, 2, 1), "a", 1)]


def test_stream_consolidates_once(spark, tmp_path):
    landing, path = f"{tmp_path}/landing", f"file://{tmp_path}/store"
    batch = store.tag(spark.createDataFrame([(1, 5), (2, 6)], "id long, best long"), "annual", "25.1", "t", "d", "t")
    batch.write.parquet(landing)
    consolidate.start(spark, landing, batch.schema, path, f"{tmp_path}/c1").awaitTermination(120)
    batch.union(store.tag(spark.createDataFrame([(3, 1)], "id long, best long"), "annual", "25.1", "t", "d", "t")).write.mode("append").parquet(landing)
    consolidate.start(spark, landing, batch.schema, path, f"{tmp_path}/c2").awaitTermination(120)
    assert rows(snapshots.read_store(spark, path).select("id"), "id") == [(1,), (2,), (3,)]


def test_registries():
    assert registry.PROFILES.names() == ["default", "production_parity"]
    with pytest.raises(KeyError, match="production_parity"):
        registry.PROFILES["absent"]
    assert registry.PROFILES["default"].with_overrides(min_pgid=1).min_pgid == 1


def test_nothing_outside_imports_the_training_data_part():
    root = Path(__file__).resolve().parents[1] / "gridloom"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"^\s*(from|import)\s.*\bllm\b", path.read_text(), re.M), path


def test_region_order(spark):
    countries = spark.createDataFrame([(1, "Mali"), (2, "MALI"), (3, "Chad"), (4, "land")], "pgid int, country string")
    specials = {"land": spark.createDataFrame([(9,)], "pgid int")}
    find = lambda name, **more: rows(query.resolve_region(name, countries, specials, **more), "pgid")
    assert find("land") == [(9,)]  # a special set comes before a country of its name
    assert find("Mali") == [(1,)] and find("mali") == [(1,), (2,)] and find("chad") == [(3,)]
    with pytest.warns(UserWarning, match="Atlantis"):
        assert find("sahel", macros={"sahel": ["Chad", "Atlantis", "mali"]}) == [(3,)]
    with pytest.raises(ValueError, match="land"):
        find("nowhere")


def test_keys_that_must_hold(spark):
    a, b = spark.range(3), spark.range(1, 4)
    with pytest.raises(ValueError, match="left"):
        quality.assert_same_keys(a, b, ["id"])
    quality.assert_same_keys(a, spark.range(3), ["id"])
    with pytest.raises(ValueError, match="repeated"):
        quality.assert_unique(a.union(b), ["id"])
    quality.assert_unique(a, ["id"])


def test_export_fills_and_counts_from_one(spark):
    cells = spark.createDataFrame([(2, 721, float("nan")), (1, 5, 2.0), (1, 720, None)], "month_id int, pgid int, a double")
    assert rows(assemble.export(cells, ["a"])) == [(1, 5, 2.0, 1.0, 5.0), (1, 720, 0.0, 1.0, 720.0), (2, 721, 0.0, 2.0, 1.0)]
    units = spark.createDataFrame([(5,), (6,)], "pgid int")
    assert [r[:3] for r in rows(assemble.export(cells, ["a"], units))] == [(1, 5, 2.0), (1, 6, 0.0), (2, 5, 0.0), (2, 6, 0.0)]


def test_checks_notice_faults(spark):
    ok = lambda df: {r["check"]: r["ok"] for r in df.collect()}
    at = lambda row: row * 720 + 1
    good = [(1, at(120), 50.0, 50.0), (2, at(260), 50.0, 50.0), (3, at(200), 50.0, 50.0)]
    schema = "month_id int, pgid int, n double, a double"
    found = ok(quality.event_grid_checks(spark.createDataFrame(good, schema), "n", ["a"], annual=(100, 200)))
    assert all(found.values()), found
    bad = [(1, at(10), 500.0, 50.0), (3, at(200), -1.0, -1.0), (4, at(300), None, 1.0), (6, at(10), 300.0, 50.0)]
    found = ok(quality.event_grid_checks(spark.createDataFrame(bad, schema), "n", ["a"], spark.createDataFrame([(at(200),)], "pgid int"), (100, 200)))
    assert not any(found.values()), found
    none = ok(quality.event_grid_checks(spark.createDataFrame([], schema), "n", ["a"]))
    assert set(none) == set(found)
    index = spark.createDataFrame([(1, 1, 0.5), (2, 1, 0.6), (1, 2, float("nan"))], "month_id int, pgid int, v double")
    assert ok(quality.index_checks(index, "v")) == {"has_values": True, "in_range": True, "constant_in_year": False}
    assert not ok(quality.index_checks(index.withColumn("v", F.col("v") + 1), "v"))["in_range"]


def test_nearest_polygon_far_away(spark):
    ring = lambda x, y: [{"x": x, "y": y}, {"x": x + 1, "y": y}, {"x": x + 1, "y": y + 1}]
    shapes = spark.createDataFrame([(1, ring(-170.0, -80.0)), (2, ring(170.0, 80.0)), (3, ring(2.0, 2.0))], "code int, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(1, -89.0, -179.0), (2, 60.0, 179.0), (3, 4.1, 0.5), (4, -40.0, -40.0)], "pgid int, lat double, lon double")
    assert rows(spatial.nearest_polygon(points, shapes).select("pgid", "code"), "pgid") == [(1, 1), (2, 2), (3, 3), (4, 3)]


def test_polygon_holes(spark, tmp_path):
    square = lambda a, b: [[a, a], [b, a], [b, b], [a, b], [a, a]]
    shapes = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"code": 7}, "geometry": {"type": "Polygon", "coordinates": [square(0, 2), square(0.5, 1.0)]}}]}
    path = tmp_path / "holes.geojson"
    path.write_text(json.dumps(shapes))
    polygons = snapshots.read_geojson(spark, str(path), T.StructType([T.StructField("code", T.IntegerType())]))
    hole = 181 * 720 + 361 + 1  # the cell from (0.5, 0.5)
    inside = {r["pgid"] for r in spatial.centroid_join(polygons).collect()}
    assert len(inside) == 15 and hole not in inside
    areas = {r["pgid"]: round(r["area"], 6) for r in spatial.area_majority_join(polygons).collect()}
    assert len(areas) == 15 and hole not in areas and set(areas.values()) == {0.25}


def test_coverage_of_polygons_that_are_not_convex(spark):
    ring = lambda *points: [{"x": float(x), "y": float(y)} for x, y in points]
    kind = "code int, ring array<struct<x:double,y:double>>, holes array<array<struct<x:double,y:double>>>"
    square = ring((0, 0), (4, 0), (4, 4), (0, 4))
    el = ring((0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4))  # 7 of the square's 16
    tilted = ring((2, 0), (4, 2), (2, 4), (0, 2))  # 8 of it
    far = ring((90, 9), (91, 9), (90, 10))
    extra = spark.createDataFrame([(1, square, []), (2, el, []), (3, tilted, []), (4, far, []), (5, square, [tilted])], kind)
    base = spark.createDataFrame([(1, el, []), (2, tilted, []), (3, square, [ring((1, 1), (3, 1), (3, 3), (1, 3))])], kind)
    got = {r["code"]: round(r["covered"], 9) for r in spatial.coverage(extra, base).collect()}
    # the last one is the square's corners, which the hole does not reach
    assert got == {1: 0.75, 2: 1.0, 3: 1.0, 4: 0.0, 5: 1.0}
    assert sorted(r["code"] for r in spatial.uncovered(extra, base.where("code = 1"), 0.5).collect()) == [1, 3, 4]  # of the corners the first covers 5 of 8


def test_common_area_is_that_of_many_points():
    rng = np.random.default_rng(5)
    for _ in range(6):
        angles = [np.sort(rng.uniform(0, 2 * np.pi, 9)) for _ in range(2)]
        one, other = ((np.c_[np.cos(a), np.sin(a)] * rng.uniform(0.2, 1, (9, 1)) + rng.uniform(-0.3, 0.3, 2)) for a in angles)
        x = np.linspace(-1.4, 1.4, 57)
        inside = lambda p: np.array([rings.crossings(p, u, v) % 2 for v in x for u in x])  # noqa: B023, E731
        wanted = float((inside(one) * inside(other)).mean()) * 2.85**2
        assert spatial._common_area([one.ravel()], [other.ravel()]) == pytest.approx(wanted, abs=0.06)


def test_landed_archives_static_covariates_and_snapshots(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("notes.txt", "x")
        z.writestr("in/table.csv", 'code,year,v,other\nAA,1990,0.5,"x\ny"\nBB,1991,,z\n')
    schema = T.StructType([T.StructField("code", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("v", T.DoubleType())])
    assert rows(snapshots.read_zipped_csv(spark, str(tmp_path / "a.zip"), schema), "code") == [("AA", 1990, 0.5), ("BB", 1991, None)]
    with pytest.raises(Exception, match="has no member"):
        snapshots.read_zipped_csv(spark, str(tmp_path / "a.zip"), schema, ".tif").collect()
    with pytest.raises(Exception, match="lacks columns"):
        snapshots.read_zipped_csv(spark, str(tmp_path / "a.zip"), schema.add("absent", T.StringType())).collect()
    (tmp_path / "s.json").write_text(json.dumps([{"gid": 5, "value": 1.5}, {"gid": 7, "value": None}]))
    assert rows(snapshots.read_static(spark, str(tmp_path / "s.json"), "slope"), "pgid") == [(5, 1.5), (7, None)]
    (tmp_path / "t.json").write_text(json.dumps([{"gid": 5, "value": 1.5}, {"gid": 5, "value": 1.5}]))
    with pytest.raises(Exception, match="there twice"):
        snapshots.read_static(spark, str(tmp_path / "t.json"), "slope").collect()
    path = f"file://{tmp_path}/events"
    snapshots.write_events([spark.createDataFrame([(1, "x")], "id int, b string"), spark.createDataFrame([(2, 3)], "id int, a int")], path)
    kept = spark.read.parquet(path)
    assert kept.columns == ["a", "b", "id"] and rows(kept, "id") == [(None, "x", 1), (3, None, 2)]
    with pytest.raises(ValueError):
        snapshots.write_events([kept.where("false")], path)
    assert spark.read.parquet(path).count() == 2


def test_levels_labels_and_years(spark):
    table = spark.createDataFrame([("Subnat", 1), ("National", 2)], "Level string, v int")
    assert rows(assemble.of_level(table)) == [("Subnat", 1)]
    with pytest.raises(Exception, match="no rows with Level Other"):
        assemble.of_level(table, level="Other").collect()
    label = analytics.place_label(F.col("lat"), F.col("lon"), {"A": (0.0, 9.0, 0.0, 9.0), "B": (5.0, 20.0, 5.0, 20.0)})
    points = spark.createDataFrame([(6.0, 6.0), (15.0, 15.0), (-30.25, -60.6)], "lat double, lon double")
    assert [r[0] for r in points.select(label).collect()] == ["A", "B", "30\u00b0S, 61\u00b0W"]
    values = spark.createDataFrame([("k", 1990, 1.0, 1), ("k", 1990, 2.0, 2), ("k", 1992, 6.0, 1), ("k", 1993, None, 1)], "key string, year int, v double, at int")
    one = expand.last_of_year(values, "key", "v", "at")
    cells = spark.createDataFrame([(1, "k"), (2, None), (3, "")], "pgid int, key string")
    got = {r["month_id"]: r["v"] for r in expand.years_to_cells(one, axes.months_between(spark, 1, 200), cells, "key", "v").collect()}
    assert (min(got), max(got), got[121], got[133], got[156]) == (121, 156, 2.0, 4.0, 6.0)
    seas = spark.createDataFrame([(1, 1.0), (0, 2.0), (None, 0.0), (-1, float("nan"))], "country_id int, f double")
    assert rows(query.excluded(seas, ["f"])) == [(3, 1, 2.0)]
