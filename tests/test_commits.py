"""Writers that meet, leases that run out, ledgers that grow."""

from __future__ import annotations

import json
import os
import threading
import time

import pytest
from gridloom.sources import commits, ledger
from pyspark.sql import functions as F


def adding(spark, *rows):
    new = spark.createDataFrame(list(rows), "id int, v string")
    return lambda base: new if base is None else base.unionByName(new)


def test_two_writers_leave_one_whole_store_and_both_ledger_rows(spark, tmp_path):
    path, book = str(tmp_path / "store"), str(tmp_path / "ledger")
    commits.commit(spark, path, adding(spark, (0, "first")), book)
    meet, tries = threading.Barrier(2, timeout=60), []

    def writer(i):
        def change(base):
            tries.append(i)
            if len(tries) <= 2:
                meet.wait()  # both have read the same commit
            return adding(spark, (i, "more"))(base)

        commits.commit(spark, path, change, book)

    threads = [threading.Thread(target=writer, args=(i,)) for i in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert sorted(r["id"] for r in commits.read(spark, path).collect()) == [0, 1, 2] and len(tries) == 3
    assert commits.history(spark, path) == [1, 2, 3] and commits.read(spark, path, 1).count() == 1
    rows = ledger.read(spark, book).collect()
    assert sorted((r["version"], r["n_events"], r["outcome"]) for r in rows) == [("1", 1, "success"), ("2", 2, "success"), ("3", 3, "success")]
    named = {commits._get(spark, f"{path}/_commits/{n:010d}.json")["folder"] for n in (1, 2, 3)}
    assert {n for n in os.listdir(path) if n.startswith("data-")} == named  # what the loser wrote is gone
    assert len(commits.vacuum(spark, path)) == 2 and commits.read(spark, path).count() == 3


def test_equal_rows_have_equal_digests_and_failures_leave_the_store(spark, tmp_path):
    path = str(tmp_path / "store")
    table = spark.range(100).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("v"))
    first = commits.commit(spark, path, lambda _: table)
    again = commits.commit(spark, path, lambda base: base.repartition(7).orderBy(F.desc("id")))
    assert first["digest"] == again["digest"] and again["number"] == 2
    with pytest.raises(Exception, match="broken"):
        commits.commit(spark, path, lambda base: base.withColumn("v", F.raise_error(F.lit("broken"))))
    assert commits.head(spark, path) == again and commits.read(spark, str(tmp_path / "none")) is None


def test_stale_leases_are_taken_over_and_held_ones_are_not(spark, tmp_path):
    path = str(tmp_path / "store")
    os.makedirs(path)
    (tmp_path / "store" / "_lease").write_text(json.dumps({"owner": "dead", "until": time.time() - 1}))
    commits.commit(spark, path, adding(spark, (1, "a")), lease_seconds=60)
    assert not os.path.exists(f"{path}/_lease")
    (tmp_path / "store" / "_lease").write_text(json.dumps({"owner": "alive", "until": time.time() + 600}))
    with pytest.raises(commits.Busy, match="alive"):
        commits.commit(spark, path, adding(spark, (2, "b")), lease_seconds=60, wait=0.2)
    assert commits.history(spark, path) == [1]
    order = []

    def holder(name):
        with commits.lease(spark, str(tmp_path / "other"), name, 60):
            order.append(f"{name} in")
            time.sleep(0.2)
            order.append(f"{name} out")

    threads = [threading.Thread(target=holder, args=(n,)) for n in "abc"]
    for t in threads:
        t.start()
    for t in threads:
        t.join(60)
    assert len(order) == 6 and all(a.split()[0] == b.split()[0] for a, b in zip(order[::2], order[1::2]))


def test_ledgers_rotate_and_tell_of_skipped_lines(spark, tmp_path):
    path = str(tmp_path / "book")
    row = lambda i: spark.createDataFrame([("d", str(i), "success", "0" * 16, "2024-01-01T00:00:00Z", 1, "xxhash64", i)], ledger.SCHEMA)
    for i in range(3):
        ledger.append(row(i), path, most_bytes=100)
    folders = [n for n in os.listdir(path) if n.startswith("rotated-")]
    assert len(folders) == 2 and ledger.read(spark, path).count() == 3 and ledger.read(spark, path, rotated=False).count() == 1
    assert ledger.skipped(spark, path) == 0
    (tmp_path / "book" / "odd.json").write_text('{"dataset": "d", "n_ev\n')
    with pytest.warns(UserWarning, match="1 malformed"):
        assert ledger.skipped(spark, path) == 1
    assert ledger.read(spark, path).count() == 3


def test_pages_csv_and_covariates_that_lack_something(spark, tmp_path):
    from gridloom.plans import registry
    from gridloom.sources import snapshots
    from pyspark.sql import types as T

    pages = spark.createDataFrame([([1] * 1500, 3000), ([1] * 500, 3000)], "Result array<int>, TotalCount long")
    assert snapshots.assert_complete(pages, "TotalCount") == 2000  # 1000 short: within the number
    with pytest.raises(ValueError, match="1200 are missing"):
        snapshots.assert_complete(pages.withColumn("TotalCount", F.lit(3200)), "TotalCount")
    assert snapshots.assert_complete(pages.withColumn("TotalCount", F.lit(200_000)).limit(0), "TotalCount") == 0
    big = pages.withColumn("Result", F.array_repeat(F.lit(1), 100_000)).withColumn("TotalCount", F.lit(201_500))
    assert snapshots.assert_complete(big, "TotalCount") == 200_000  # 1500 short: within the share
    (tmp_path / "c.csv").write_text("b,a,c\n1,007,x\n2,,y\n")
    kinds = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType())])
    assert [tuple(r) for r in snapshots.read_csv(spark, str(tmp_path / "c.csv"), ["a", "b"], kinds).collect()] == [("007", 1.0), (None, 2.0)]
    for wanted in (["a", "z"], ["c"]):
        with pytest.raises(ValueError, match="missing columns"):
            snapshots.read_csv(spark, str(tmp_path / "c.csv"), wanted, kinds)
    values = spark.createDataFrame([("NOR", 2020, 0.1)], "country_text_id string, year int, v2x_libdem double")
    with pytest.raises(ValueError, match="v2x_accountability"):
        registry.build_covariates(values, values, registry.COVARIATES["vdem"])
    assert len(registry.COVARIATES["vdem"].variables) == 22 and len(registry.COVARIATES["shdi"].variables) == 4 and registry.RASTERS["ghspop"].epochs[0] == 1975
