"""Sources to one wide feature table, dense only where asked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import axes

KEYS = ("month_id", "pgid")


def stack(axis: DataFrame, sources: Sequence[DataFrame], static: Sequence[DataFrame] = (), fills: Mapping[str, float] | None = None) -> DataFrame:
    """Left joins of sparse sources on (month, cell), and of static tables on the cell, from an axis.

    Absent values become ``fills`` (0 unless named).  Two sources with a feature of one name are an error.
    """
    names = [c for s in [*sources, *static] for c in s.columns if c not in KEYS]
    double = sorted({n for n in names if names.count(n) > 1})
    if double:
        raise ValueError(f"features of several sources: {double}")
    out = reduce(lambda left, right: left.join(right, list(KEYS), "left"), sources, axis)
    out = reduce(lambda left, right: left.join(right, "pgid", "left"), static, out)
    fills = fills or {}
    return out.select(*KEYS, *[F.coalesce(F.col(n), F.lit(fills.get(n, 0))).alias(n) for n in names])


def boundaries(table: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature, first and last month with a positive total; months are aggregated before features."""
    months = table.groupBy("month_id").agg(*[F.sum(c).alias(c) for c in features])
    long = months.select("month_id", F.explode(F.map_from_arrays(F.array(*map(F.lit, features)), F.array(*[F.col(c).cast("double") for c in features]))).alias("feature", "total"))
    return long.groupBy("feature").agg(F.min(F.when(F.col("total") > 0, F.col("month_id"))).alias("first_month"), F.max(F.when(F.col("total") > 0, F.col("month_id"))).alias("last_month"))


def densify(table: DataFrame, spine: DataFrame, fills: Mapping[str, float]) -> DataFrame:
    """Every row of a spine of keys, with fills where the table has none."""
    return spine.join(table, list(KEYS), "left").select(*KEYS, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in fills.items()])


def coalesce_levels(fine: DataFrame, coarse: DataFrame, key: str, value: str) -> DataFrame:
    """Full outer join of two crosswalks, the finer one first."""
    right = coarse.withColumnRenamed(value, "_coarse")
    return fine.join(right, key, "full_outer").select(key, F.coalesce(value, "_coarse").alias(value))


def merge_indicators(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inner join of indicator tables on their keys."""
    return reduce(lambda a, b: a.join(b, list(keys)), tables)


def completeness(table: DataFrame, features: Sequence[str]) -> Column:
    """Whether a row has a value (neither null nor NaN) in all features."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features])


def row_loss(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row: keys of the first table, and how many of them :func:`merge_indicators` loses."""
    first = tables[0].select(*keys).distinct()
    marked = reduce(lambda a, b: a.join(b.select(*keys).distinct().withColumn(f"_in{len(a.columns)}", F.lit(1)), list(keys), "left"), tables[1:], first)
    lost = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in marked.columns if c.startswith("_in")], F.lit(False))
    return marked.agg(F.count(F.lit(1)).alias("n_first"), F.count(F.when(lost, 1)).alias("n_lost"))


def of_level(table: DataFrame, column: str = "Level", level: str = "Subnat") -> DataFrame:
    """Rows of one administrative level; none at all is an error when the rows are read."""
    some = table.agg(F.count(F.when(F.col(column) == level, 1)).alias("_n"))
    counted = table.where(F.col(column) == level).unionByName(some.where("_n = 0"), allowMissingColumns=True)
    fault = F.raise_error(F.lit(f"no rows with {column} {level}")).cast("boolean")
    return counted.where(F.when(F.col("_n").isNull(), True).otherwise(fault)).drop("_n")


def unmatched(rows: DataFrame, crosswalk: DataFrame, key: str) -> DataFrame:
    """Keys (neither null nor empty) without an entry in the crosswalk, with their number of rows."""
    named = rows.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return named.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).join(crosswalk.select(key), key, "left_anti")


def export(cells: DataFrame, features: Sequence[str], units: DataFrame | None = None, grid: axes.GridConfig = axes.GRID) -> DataFrame:
    """month_id, priogrid_id, features with 0 for null and NaN, row and col (doubles from 1), in order.

    With ``units`` (a table of pgids) the result is dense: each of them in every month that ``cells`` has,
    and no other cell.
    """
    value = lambda c: F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c)
    if units is not None:
        cells = axes.spine(cells.select("month_id").distinct(), units.select("pgid").distinct()).join(cells, list(KEYS), "left")
    place = [(at(F.col("pgid"), grid) + 1).cast("double").alias(name) for at, name in ((axes.pgid_row, "row"), (axes.pgid_column, "col"))]
    return cells.select("month_id", F.col("pgid").alias("priogrid_id"), *map(value, features), *place).orderBy("month_id", "priogrid_id")
