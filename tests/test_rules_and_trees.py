"""Rules of one's own, digest trees, running sums in many tasks and stored sketches."""

from __future__ import annotations

import datetime
import random

import pytest
from gridloom.operators import analytics, expand, gridagg, quality, resolve
from gridloom.plans import catalogue, registry, rules
from gridloom.sources import difftree
from pyspark.sql import functions as F


@pytest.fixture
def opened(monkeypatch):
    """Registries that are as before after the test."""
    for module, name in ((expand, "TABLE_RULES"), (expand, "SPATIAL"), (resolve, "SURVIVORSHIP"), (gridagg, "AGGREGATIONS")):
        monkeypatch.setattr(module, name, dict(getattr(module, name)))


def quarters(row):
    """A fourth to the month of the end, the rest to the first of its year."""
    end = row["date_end"]
    for month, share in ((end.replace(day=1), 0.25), (datetime.date(end.year, 1, 1), 0.75)):
        yield month, {a: row[a] * share for a in ("best", "low", "high")}


def test_rules_of_ones_own_run_through_a_viewpoint_and_from_sql(spark, sf, opened):
    rules.temporal("quarters", quarters)
    rules.survivorship("candidates_win", lambda kind: F.when(kind == "candidate", 9).otherwise(F.length(kind)))
    rules.spatial("to_one", lambda rows, current, polygons: rows.withColumns({"priogrid_gid": F.lit(7), "_spatial_distributed": F.lit(True)}))
    rules.aggregation("mean", lambda c, v: F.avg(F.when(c, v)))
    store = catalogue.spans(spark, sf).withColumn("priogrid_gid", F.col("cell"))
    view = registry.Viewpoint("candidates_win", "even_split", "to_one", {"annual": "quarters"}, True, 1, 3, (4, 6))
    build = registry.viewpoint(store, view, ties=catalogue.TIES)
    rows = build.rows.collect()
    plain = resolve.survivors(resolve.drop_stale(store), "candidates_win", catalogue.TIES).where("type_of_violence <= 3").collect()
    annual = [r for r in plain if r["_source_type"] == "annual"]
    assert len(annual) > 10 and sum(r["_source_type"] == "annual" for r in rows) == 2 * len(annual)
    for r in annual[:20]:
        own = {(o["date_month"], o["best"]) for o in rows if o["id"] == r["id"]}
        assert own == {(m, p["best"]) for m, p in quarters(r.asDict())}
    assert {r["priogrid_gid"] for r in rows} == {7} and build.check()["n_store"] == store.count()
    rules.register_sql(spark, "quarters")
    store.where("_source_type = 'annual'").limit(50).createOrReplaceTempView("own_events")
    spark.sql("CREATE OR REPLACE TEMP VIEW own_events2 AS SELECT * FROM own_events ORDER BY id, nth")
    found = spark.sql("SELECT id, sum(best) AS best, count(*) AS n FROM quarters(TABLE(own_events2) PARTITION BY id) GROUP BY id")
    want = spark.sql("SELECT id, sum(best) AS best, 2 * count(*) AS n FROM own_events2 GROUP BY id")
    assert sorted((r["id"], r["best"], r["n"]) for r in found.collect()) == sorted((r["id"], float(r["best"]), r["n"]) for r in want.collect())
    spec = gridagg.FeatureSpec("mean_best", "mean", "best")
    grid = gridagg.compile_grid(spark.createDataFrame([(1, 1, 2), (1, 1, 4)], "month_id int, pgid int, best int"), [spec])
    assert grid.head()["mean_best"] == 3.0


def test_names_are_taken_once_and_unknown_ones_listed(spark, opened):
    rules.temporal("quarters", quarters)
    for again in (lambda: rules.temporal("quarters", quarters), lambda: rules.temporal("even_split", quarters), lambda: rules.survivorship("annual_wins", {}), lambda: rules.spatial("passthrough", None), lambda: rules.aggregation("count", None)):
        with pytest.raises(ValueError, match="already"):
            again()
    with pytest.raises(KeyError, match="there are"):
        rules.register_sql(spark, "nothing")
    events = spark.createDataFrame([(1, "a", None, datetime.date(2024, 1, 1), 5, 5, 5, 1)], "id int, _source_type string, date_start date, date_end date, best int, low int, high int, date_prec int")
    with pytest.raises(KeyError, match="quarters"):
        expand.split_months(events, "thirds")
    both = expand.split_months(events.unionByName(events.withColumn("_source_type", F.lit("b"))), "date_end_only", by_source={"b": "quarters"})
    assert sorted((r["_source_type"], r["best"]) for r in both.collect()) == [("a", 5.0), ("b", 1.25), ("b", 3.75)]


def test_one_changed_event_reads_one_range_of_each_side(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.randrange(100), None if i % 7 else "x") for i in range(3000)]
    table = lambda r: spark.createDataFrame(r, "id long, v int, note string")
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    difftree.write(table(rows), old, "id")
    changed = [(i, v + (i == 1234), n) for i, v, n in reversed(rows)]
    difftree.write(table(changed), new, "id")
    ranges = difftree.differing(spark, old, new)
    assert len(ranges) == 1
    assert {f.split("range=")[1].split("/")[0] for p in (old, new) for f in difftree.read(spark, p, ranges).inputFiles()} == {str(ranges[0])}
    assert [tuple(r) for r in difftree.diff(spark, old, new, "id", "v").collect()] == [(1234, "revised", 1)]
    more = [r for r in changed if r[0] % 500] + [(9000 + i, 1, None) for i in range(3)]
    difftree.write(table(more), new, "id")
    order = lambda df: sorted(map(tuple, df.collect()))
    assert order(difftree.diff(spark, old, new, "id", "v")) == order(quality.snapshot_diff(table(rows), table(more), "id", "v"))
    difftree.write(table(rows), new, "id")
    assert difftree.differing(spark, old, new) == [] and difftree.diff(spark, old, new, "id", "v").count() == 0
    difftree.write(table([]), new, "id")
    assert len(difftree.differing(spark, old, new)) == 256 and difftree.diff(spark, old, new, "id", "v").count() == 3000
    difftree.write(table(rows), new, "id", levels=1)
    with pytest.raises(ValueError, match="levels"):
        difftree.differing(spark, old, new)


def test_running_sums_of_one_group_in_many_tasks(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["all"] * 9 + ["few", None]), i, rng.choice([None, *range(50)])) for i in range(2000)]
    table = spark.createDataFrame(rows, "g string, unit int, v int").repartition(8)
    out = analytics.running(table, "g", "v", "v", "unit")
    got = {r["unit"]: (r["place"], r["running"]) for r in out.collect()}
    for g in ("all", "few", None):
        total = 0
        for i, (_, unit, v) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[2] is not None, r[2] or 0, r[1])), 1):
            total += v or 0
            assert got[unit] == (i, total)
    held = table.where("v is not null and g is not null")
    share = lambda df: {r["unit"]: round(r["share"], 9) for r in df.collect()}
    assert share(analytics.lorenz_spread(held, "g", "unit", "v")) == share(analytics.lorenz(held, "g", "unit", "v"))
    ranks = lambda **how: sorted(map(tuple, analytics.ordinal_ranks(held, "g", "v", "unit", **how).select("unit", "rank").collect()))
    assert ranks(spread=True) == ranks()


def test_sketches_of_months_give_those_of_the_year(spark, tmp_path):
    rng = random.Random(5)
    rows = [(m, rng.randrange(4000), rng.choice([0.0, None, float("nan"), rng.expovariate(0.01)])) for m in range(1, 13) for _ in range(1500)]
    table = spark.createDataFrame(rows, "month_id int, pgid int, v double")
    analytics.sketches(table, ["month_id"], "v", "pgid").write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    assert stored.count() == 12
    values = sorted(v for *_, v in rows if v is not None and v == v)
    year = analytics.merged(stored).head()
    assert year["n"] == len(values)
    exact = len({p for _, p, v in rows if v and v == v})
    assert abs(year["n_cells"] - exact) <= 0.05 * exact
    for p in (5, 25, 50, 75, 95):
        low, high = (values[min(len(values) - 1, max(0, int((p / 100 + d) * len(values))))] for d in (-0.015, 0.015))
        assert low <= year[f"p{p}"] <= high
    half = analytics.merged(stored.where("month_id <= 6"), at=[0.5]).head()
    assert half["n"] == sum(m <= 6 and v is not None and v == v for m, _, v in rows)
    assert analytics.merged(stored.limit(0)).count() == 0
