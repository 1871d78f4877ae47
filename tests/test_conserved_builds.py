"""Builds that count while they run, and cubes that are recomputed only where their input changed."""

from __future__ import annotations

import glob
import os

import pytest
from gridloom.operators import gridagg, resolve
from gridloom.plans import catalogue, incremental, registry
from gridloom.sources import snapshots
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def store(spark, sf):
    return catalogue.spans(spark, sf).withColumn("priogrid_gid", F.col("cell"))


def scans(frame) -> int:
    return frame._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_counts_come_from_the_pass_that_makes_the_rows(spark, store):
    build = registry.viewpoint(store, registry.PROFILES["production_parity"], ties=catalogue.TIES)
    plain = resolve.survivors(resolve.drop_stale(store), "dot9_wins", catalogue.TIES)
    assert scans(build.rows) == scans(plain) == 2 * scans(store)  # of two tables each
    counts = build.run()
    assert counts["n_store"] == store.count() == counts["n_stale"] + counts["n_superseded"] + counts["n_survivors"]
    assert counts["n_survivors"] == plain.count() and counts["n_kept"] == build.rows.count()
    again = registry.viewpoint_accounting(store, registry.PROFILES["production_parity"], catalogue.TIES).head().asDict()
    assert {k: counts[k] for k in again} == again


def test_a_build_that_loses_or_multiplies_rows_raises_and_leaves_the_store(spark, store, tmp_path, monkeypatch):
    path = str(tmp_path / "view")
    view = registry.PROFILES["default"]
    counts = registry.viewpoint(store, view, ties=catalogue.TIES).write(path)
    assert spark.read.parquet(path).count() == counts["n_kept"]
    before = sorted(os.listdir(path))
    real = resolve.with_status
    for broken in (lambda df: df.where("id % 7 <> 0"), lambda df: df.unionByName(df.where("id % 7 = 0"))):
        monkeypatch.setattr(resolve, "with_status", lambda *a, broken=broken: broken(real(*a)))
        with pytest.raises(registry.NotConserved, match="n_store"):
            registry.viewpoint(store, view, ties=catalogue.TIES).write(path)
        assert sorted(os.listdir(path)) == before and os.listdir(tmp_path) == ["view"]
    none = registry.viewpoint(store.limit(0), view, ties=catalogue.TIES).run()
    assert none["n_store"] == none["n_survivors"] == 0
    typed = spark.createDataFrame([("Battles", "2024-01-02"), (None, "2024-02-02"), ("Riots", None)], "event_type string, event_date string")
    assert registry.typed(typed, registry.TYPED_PROFILES["acled_violence_only"]).run() == {"n_input": 3, "n_output": 1, "n_filtered": 2}


def test_tasks_that_ran_twice_do_not_break_a_build(spark, store, monkeypatch):
    build = registry.viewpoint(store, registry.PROFILES["default"], ties=catalogue.TIES)
    build.rows.write.format("noop").mode("overwrite").save()
    real = [one.get for one in build.seen]
    twice = iter([real[0] | {"n_store": real[0]["n_store"] + 5}, *real[1:]])

    class Seen:
        def __init__(self, get):
            self.get = get

    counts = registry.Build(build.rows, tuple(Seen(next(twice)) for _ in real), build.equations, build.recount).check()
    assert counts["n_store"] == store.count()


def test_stale_rows_equal_those_of_the_rule_as_written(spark):
    rows = []
    for i in range(400):
        kind = ("annual", "dot9", "candidate", "dot9")[i % 4]
        version = {"annual": "25.1", "candidate": f"25.0.{i % 3}", "dot9": f"25.9.{i % 5 + 8}"}[kind]
        rows.append((i * 7 % 60 if i % 11 else None, kind, version, f"2024-{i % 12 + 1:02d}-01" if i % 9 else None, i))
    for kept in (rows, [r for r in rows if r[1] != "annual"], [r for r in rows if r[1] != "dot9"], rows[:1], []):
        table = spark.createDataFrame(kept, "id long, _source_type string, _source_version string, date_end string, n int")
        for kleene in (False, True):
            annual = [r for r in kept if r[1] == "annual"]
            known, last = {r[0] for r in annual} - {None}, max((r[3] for r in annual if r[3]), default=None)
            later = lambda r: last is None or (r[3] is not None and r[3] > last)  # noqa: B023, E731
            current = [r for r in kept if r[1] == "annual" or ((r[0] in known or later(r)) and (kleene or r[3] is not None))]
            key = lambda r: [int(x) for x in r[2].split(".")]
            newest = max((key(r) for r in current if r[1] == "dot9"), default=None)
            want = sorted(r[4] for r in current if r[1] != "dot9" or key(r) == newest)
            assert sorted(r["n"] for r in resolve.drop_stale(table, kleene).collect()) == want


FEATURES = [gridagg.FeatureSpec("n"), gridagg.FeatureSpec("best", "sum_field", "best")]


def listed(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/year=*/*.parquet")}


def test_only_years_of_changed_months_are_written_again(spark, tmp_path):
    path = str(tmp_path / "cube")
    row = lambda i, version, month, best: (i, "annual", version, month, i % 5 + 1, best)
    rows = [row(i, f"25.{i % 3}", 481 + i % 36, i) for i in range(300)]
    table = lambda r: spark.createDataFrame(r, "id long, _source_type string, _source_version string, month_id int, pgid int, best long")
    calls = []

    def chosen(store):
        calls.append("resolve")
        return resolve.survivors(store)

    make = lambda r, settings="a": incremental.refresh(table(r), chosen, lambda x: gridagg.compile_grid(x, FEATURES), path, settings)

    def whole(r):
        cube = gridagg.compile_grid(resolve.survivors(table(r)), FEATURES)
        assert sorted(map(tuple, spark.read.parquet(path).select(*cube.columns).collect())) == sorted(map(tuple, cube.collect()))

    assert make(rows).written == (2020, 2021, 2022)
    whole(rows)
    first = listed(path)
    done = make(list(reversed(rows)))
    assert done.skipped and done.reason == "same vintages and files" and calls == ["resolve"] and listed(path) == first
    changed = [row(i, v, m, b + 1 if v == "25.1" and 493 <= m <= 495 else b) for i, _, v, m, _, b in rows]
    done = make(changed)
    assert done.changed == ("annual/25.1",) and done.written == (2021,) and not done.removed
    whole(changed)
    now = listed(path)
    kept = {f for f in first if "year=2021" not in f}
    assert {f: now[f] for f in kept} == {f: first[f] for f in kept} and not {f for f in first if "year=2021" in f} & set(now)
    later = changed + [row(900, "25.9", 481 + 40, 5), row(1, "26.0", 481 + 20, 77)]  # a new year, and an event that moves
    done = make(later)
    assert done.written == (2020, 2021, 2023)
    whole(later)
    gone = [r for r in later if r[3] < 517]
    assert make(gone).removed == (2023,) and "year=2023" not in os.listdir(path)
    whole(gone)
    lost = next(f for f in listed(path) if "year=2020" in f)
    os.remove(lost)
    assert make(gone).written == (2020,)
    whole(gone)
    assert make(gone, "b").reason == "other settings" and make(gone, "b").skipped


def test_a_failed_refresh_is_made_good_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "cube")
    table = spark.createDataFrame([(i, "annual", "1", 481 + i, 1, i) for i in range(30)], "id long, _source_type string, _source_version string, month_id int, pgid int, best long")
    make = lambda t: incremental.refresh(t, resolve.survivors, lambda x: gridagg.compile_grid(x, FEATURES), path)
    make(table)
    other = table.withColumn("best", F.col("best") + (F.col("month_id") > 500).cast("int"))
    with monkeypatch.context() as m:
        m.setattr(snapshots, "write_store", lambda *a, **k: (_ for _ in ()).throw(OSError("full")))
        with pytest.raises(OSError):
            make(other)
    assert make(other).written == (2021, 2022)
    assert spark.read.parquet(path).agg(F.sum("best")).head()[0] == other.agg(F.sum("best")).head()[0]


def test_a_cube_survives_a_failed_write(spark, tmp_path):
    path = str(tmp_path / "cube")
    good = spark.createDataFrame([(481, 1, 2.0), (493, 1, 4.0)], "month_id int, pgid int, a double")
    snapshots.write_cube(good, path)
    bad = good.withColumn("a", F.when(F.col("month_id") > 481, F.raise_error(F.lit("no")).cast("double")).otherwise(F.col("a")))
    with pytest.raises(Exception, match="no"):
        snapshots.write_cube(bad, path)
    assert sorted(r["a"] for r in spark.read.parquet(path).collect()) == [2.0, 4.0] and os.listdir(tmp_path) == ["cube"]


def test_upsert_refuses_a_repeated_key_and_keeps_new_columns(spark):
    from gridloom.operators import store as ops

    old = spark.createDataFrame([(1, "2024-01-01", "old"), (2, None, "old"), (None, "2024-01-01", "old")], "id long, t string, v string")
    new = spark.createDataFrame([(1, "2024-01-01", "new", 5), (2, "2024-01-01", "new", 6), (None, "2024-02-01", "new", 7), (3, None, "new", 8)], "id long, t string, v string, more int")
    got = {r["id"]: (r["v"], r["more"]) for r in ops.upsert_latest(old, new, "id", "t").collect()}
    assert got == {1: ("old", None), 2: ("new", 6), None: ("new", 7), 3: ("new", 8)}
    for a, b in ((old.unionByName(old.limit(1)), new), (old, new.unionByName(new.where("id = 3")))):
        with pytest.raises(Exception, match="there twice"):
            ops.upsert_latest(a, b, "id", "t").collect()
