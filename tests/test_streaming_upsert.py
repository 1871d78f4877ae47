"""Keyed streaming upserts against the batch operator, over restarts and repeated batches."""

from __future__ import annotations

import os
import random

import pytest
from gridloom.operators import store as ops
from gridloom.streaming import upsert
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("_ingested_at", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("note", T.StringType())])


@pytest.fixture(autouse=True)
def one_partition(spark):
    """State of one partition: each has a process of its own in every batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, tmp_path, **how):
    query = upsert.start(spark, str(tmp_path / "landing"), SCHEMA, str(tmp_path / "log"), str(tmp_path / "checkpoint"), **how)
    query.awaitTermination(120)
    assert query.exception() is None


def log(spark, tmp_path):
    return spark.read.schema(T.StructType([*SCHEMA.fields, T.StructField("batch", T.LongType())])).parquet(str(tmp_path / "log"))


def test_later_and_earlier_rows_over_restarts_equal_the_batch_upsert(spark, tmp_path):
    rng = random.Random(6)
    batches = [[(i, rng.choice([None, *[f"2024-0{m}-01" for m in range(1, 9)]]), 10 * n + i, None) for i in range(12) if rng.random() < 0.7] for n in range(2)]
    want = spark.createDataFrame([], SCHEMA)
    for rows in batches:  # each with a restart of the query
        land(spark, tmp_path / "landing", rows)
        run(spark, tmp_path)
        want = ops.upsert_latest(want, spark.createDataFrame(rows, SCHEMA), "id", "_ingested_at")
    got = sorted(tuple(r) for r in upsert.current(log(spark, tmp_path)).collect())
    assert got == sorted(tuple(r) for r in want.collect())
    changed = log(spark, tmp_path).groupBy("batch").count().collect()
    assert sum(r["count"] for r in changed) < sum(map(len, batches))  # rows that change nothing are not logged
    store = str(tmp_path / "store")
    for _ in range(2):
        assert sorted(tuple(r) for r in upsert.compact(spark, str(tmp_path / "log"), store, SCHEMA).collect()) == got


def test_one_start_over_several_batches_and_null_keys(spark, tmp_path):
    for rows in ([(1, "2024-02-01", 1, "a"), (1, "2024-03-01", 2, "b"), (None, None, 3, None)], [(1, "2024-01-01", 4, None), (None, "2024-01-01", 5, None)], [(2, None, 6, None)]):
        land(spark, tmp_path / "landing", rows)
    run(spark, tmp_path, files=1)
    assert {r["id"]: r["v"] for r in upsert.current(log(spark, tmp_path)).collect()} == {1: 2, None: 5, 2: 6}


def test_a_batch_that_is_tried_again_counts_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01", 1, None)], SCHEMA)
    write = upsert._append(str(tmp_path / "log"))
    write(rows, 0)
    write(rows, 0)
    assert log(spark, tmp_path).count() == 1 and os.listdir(tmp_path / "log") == ["batch=0"]


class Handle:
    """A key's state and timers, as a stream would hold them."""

    def __init__(self) -> None:
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def listTimers(self):
        return list(self.timers)

    def deleteTimer(self, timer):
        self.timers.remove(timer)

    def registerTimer(self, timer):
        self.timers.append(timer)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentProcessingTimeInMs(self):
        return self.ms


def test_timers_drop_the_state_of_keys_that_do_not_change(spark):
    latest, handle = upsert.Latest("t", T.StringType(), forget=10), Handle()
    latest.init(handle)
    take = lambda at, *times: [r["t"] for r in latest.handleInputRows(("k",), iter([{"t": t} for t in times]), Clock(at))]
    assert take(0, "2024-02-01", "2024-03-01", "2024-01-01") == ["2024-03-01"] and handle.timers == [10_000]
    assert take(4_000, "2024-02-15", None) == [] and handle.timers == [10_000]
    assert take(5_000, "2024-04-01") == ["2024-04-01"] and handle.timers == [15_000]
    assert list(latest.handleExpiredTimer(("k",), Clock(15_000), None)) == [] and not handle.exists()
    assert take(20_000, "2024-01-01") == ["2024-01-01"]  # it goes to the log, where the later one wins
    rows = [(1, "2024-04-01", 1, None, 0), (1, "2024-01-01", 4, None, 1)]
    log_rows = spark.createDataFrame(rows, T.StructType([*SCHEMA.fields, T.StructField("batch", T.LongType())]))
    assert [r["v"] for r in upsert.current(log_rows).collect()] == [1]
