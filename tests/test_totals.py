"""Totals of distributed events, without a row for each event and cell."""

from __future__ import annotations

from gridloom.operators import expand
from gridloom.plans import catalogue, registry
from pyspark.sql import functions as F


def plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def same(totals, made, by=()):
    """Totals equal the sums of the rows."""
    sums = made.groupBy(*by, "priogrid_gid").agg(F.sum("best").alias("best"), F.sum("high").alias("high"), F.count(F.lit(1)).alias("n"))
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(r) for r in totals.select(*by, "priogrid_gid", "best", "high", "n").collect()), key=key)
    assert totals.dtypes == sums.dtypes and got == sorted((tuple(r) for r in sums.collect()), key=key) and got


def test_totals_are_the_sums_of_the_rows(spark):
    rows = [(i % 5, None if i % 11 == 0 else i % 9, i % 8 or None, None if i % 13 == 0 else i % 6 * 7 - 5, i % 4 * 100) for i in range(400)]
    events = spark.createDataFrame(rows, "month int, priogrid_gid int, where_prec int, best long, high long")
    codes = spark.createDataFrame([(1, 10), (2, 10), (3, 10), (4, 20), (5, 20), (6, None), (7, 30)], "pgid int, code int")
    weights = spark.createDataFrame([(10, 1, 0.5), (10, 2, 0.3), (10, 3, 0.2), (20, 4, 0.9), (20, 5, 0.1)], "code int, pgid int, share double")
    for by in ((), ("month",)):
        same(expand.distribute_totals(events, weights, codes, by, ("best", "high")), expand.distribute(events, weights, codes, ("best", "high")), by)
    levels = codes.withColumn("level", F.lit(1)).unionByName(codes.where("pgid <> 3").select("pgid", F.lit(7).alias("code"), F.lit(0).alias("level")))
    both = weights.withColumn("level", F.lit(1)).unionByName(spark.createDataFrame([(7, p, 0.2) for p in (1, 2, 4, 5, 7)], "code int, pgid int, share double").withColumn("level", F.lit(0)))
    fractions = events.withColumns({"best": F.col("best") / 2, "high": F.col("high").cast("double")})
    for frame in (events, fractions, events.limit(0).unionByName(events.where("where_prec < 4")), events.where("where_prec >= 4")):
        same(expand.distribute_totals(frame, both, levels, ("month",), ("best", "high")), expand.distribute(frame, both, levels, ("best", "high")), ("month",))
    assert expand.distribute_totals(events.limit(0), both, levels, ("month",)[:0], ("best",)).count() == 0


def test_totals_of_a_view_keep_its_row_filters(spark, sf):
    store = catalogue.spans(spark, sf).withColumn("priogrid_gid", F.col("cell"))
    polygons = catalogue._polygons(spark, sf)
    for view in (registry.PROFILES["production_parity"].with_overrides(spatial="proportional"), registry.PROFILES["default"], registry.PROFILES["production_parity"]):
        made = registry.build_viewpoint(store, view, polygons, catalogue.TIES).groupBy("date_month", "priogrid_gid").agg(F.round(F.sum("best"), 4).alias("best"), F.count(F.lit(1)).alias("n"))
        totals = registry.viewpoint_totals(store, view, ("date_month",), polygons, catalogue.TIES).withColumn("best", F.round("best", 4))
        assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, made.collect()))


def test_viewpoint_of_two_levels_makes_no_row_for_each_event_and_cell(spark, sf):
    assert "posexplode" not in plan(catalogue.viewpoint_two_levels(spark, sf))


def test_distribution_makes_no_row_for_each_event_and_cell(spark, sf):
    assert "posexplode" not in plan(catalogue.proportional_distribution(spark, sf))


def test_default_viewpoint_makes_no_row_for_each_event_and_cell(spark, sf):
    assert "posexplode" not in plan(catalogue.viewpoint_default(spark, sf))
