"""Yearly values to months: step (last known) and linear."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def step(values: DataFrame, months: DataFrame, key: str, value: str) -> DataFrame:
    """(key, month_id, value): the last value known at each month, 0 before the first.

    ``values`` has key, month_id and value; ``months`` the axis, which is broadcast.
    """
    grid = values.select(key).distinct().crossJoin(F.broadcast(months))
    joined = grid.join(values.select(key, "month_id", F.col(value).alias("_v")), [key, "month_id"], "full_outer")
    known = Window.partitionBy(key).orderBy("month_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = joined.withColumn(value, F.coalesce(F.last("_v", ignorenulls=True).over(known), F.lit(0.0)))
    return filled.join(F.broadcast(months), "month_id", "left_semi").select(key, "month_id", value)


def linear(values: DataFrame, months: DataFrame, key: str, value: str) -> DataFrame:
    """(key, month_id, value) between yearly values (key, year, value): 0 before the first, held after the
    last, and linear in year + (month - 1) / 12 between."""
    by_year = Window.partitionBy(key).orderBy("year")
    brackets = values.where(F.col(value).isNotNull()).select(
        key, F.col("year").alias("_y0"), F.col(value).alias("_v0"), F.lead("year").over(by_year).alias("_y1"), F.lead(value).over(by_year).alias("_v1"), F.row_number().over(by_year).alias("_n")
    )
    ids = months.select("month_id", (1980 + (F.col("month_id") - 1) / 12).alias("_t"))
    bounds = ids.agg(F.min("month_id").alias("a"), F.max("month_id").alias("b"))
    # each bracket makes its own months, so nothing is joined on a range
    first = F.greatest(F.col("a"), ((F.col("_y0") - 1980) * 12 + 1).cast("int"))
    last = F.least(F.col("b"), F.coalesce(((F.col("_y1") - 1980) * 12).cast("int"), F.col("b")))
    start = F.when(F.col("_n") == 1, F.col("a")).otherwise(first)
    rows = brackets.crossJoin(F.broadcast(bounds)).where(start <= last).withColumn("month_id", F.explode(F.sequence(start, last)))
    t = F.floor((F.col("month_id") - 1) / 12) + 1980 + F.pmod(F.col("month_id") - 1, F.lit(12)) / 12
    slope = (F.col("_v1") - F.col("_v0")) / (F.col("_y1") - F.col("_y0"))
    at = F.when(t < F.col("_y0"), F.lit(0.0)).when(F.col("_y1").isNull(), F.col("_v0")).otherwise(F.col("_v0") + slope * (t - F.col("_y0")))
    return rows.select(key, "month_id", at.cast("double").alias(value)).join(F.broadcast(months), "month_id", "left_semi").select(key, "month_id", value)
