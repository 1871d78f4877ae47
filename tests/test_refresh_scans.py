"""How often a refresh of a cube reads its store."""

from __future__ import annotations

from gridloom.operators import gridagg
from gridloom.plans import incremental
from pyspark.sql import functions as F


def test_a_refresh_reads_the_store_once_for_vintages_and_once_for_rows(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def amount(i: int) -> int:
        seen.add(1)
        return i

    counted = F.udf(amount, "long")
    store = lambda more: spark.range(100).select(
        F.lit("annual").alias("_source_type"), (F.col("id") % 3 + more).cast("string").alias("_source_version"), counted("id").alias("best"),
        (F.col("id") % 30 + 200).cast("int").alias("month_id"), (F.col("id") % 7).cast("int").alias("pgid"),
    )
    path = f"file://{tmp_path}/cube"
    make = lambda more: incremental.refresh(store(more), lambda rows: rows, lambda rows: gridagg.compile_grid(rows, [gridagg.FeatureSpec("best", "sum_field", "best")]), path)
    assert make(0).reason == "no previous run" and seen.value == 200
    assert make(1).reason == "other vintages" and seen.value == 400
    assert make(1).skipped and seen.value == 500
    assert spark.read.parquet(path).agg(F.sum("best")).head()[0] == sum(range(100))
