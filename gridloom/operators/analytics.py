"""Analytics over (month, unit) tables: changes, onsets, ranks, concentration, plausibility."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import snapshots


def change(table: DataFrame, unit: str, value: str, out: str = "change") -> DataFrame:
    """Add the difference to the unit's row before; null for its first."""
    return table.withColumn(out, F.col(value) - F.lag(value).over(Window.partitionBy(unit).orderBy("month_id")))


def max_abs_change(table: DataFrame, unit: str, value: str) -> DataFrame:
    return change(table, unit, value).groupBy(unit).agg(F.coalesce(F.max(F.abs("change")), F.lit(0)).alias("max_abs_change"))


def first_onset(table: DataFrame, unit: str, value: str) -> DataFrame:
    """First month with a positive value; null without one."""
    return table.groupBy(unit).agg(F.min(F.when(F.col(value) > 0, F.col("month_id"))).alias("first_month"))


def top_series(table: DataFrame, unit: str, value: str, k: int = 12) -> DataFrame:
    """All rows of the k units with the largest totals (ties to the smaller unit)."""
    best = table.groupBy(unit).agg(F.sum(value).alias("_total")).orderBy(F.desc("_total"), unit).limit(k).select(unit)
    return table.join(F.broadcast(best), unit, "left_semi")


def top_per_group(table: DataFrame, group: str, value: str, k: int, *ties: str) -> DataFrame:
    """The k largest rows of each group, with their ``rank`` from 1."""
    order = Window.partitionBy(group).orderBy(F.desc(value), *ties)
    return table.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def lorenz(table: DataFrame, group: str, unit: str, value: str) -> DataFrame:
    """Add the cumulative share of each group's value, smallest first (ties by unit)."""
    order = Window.partitionBy(group).orderBy(value, unit)
    running = F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return table.withColumn("share", running / F.sum(value).over(Window.partitionBy(group)))


def gini(table: DataFrame, group: str, unit: str, value: str, spread: bool = False) -> DataFrame:
    """1 - 2 (sum of c - (first + last) / 2) / n over the cumulative shares c of each group; with ``spread``, by
    :func:`running`."""
    rows = lorenz_spread(table, group, unit, value) if spread else lorenz(table, group, unit, value)
    c = rows.groupBy(group).agg(F.sum("share").alias("s"), F.min("share").alias("a"), F.max("share").alias("b"), F.count(F.lit(1)).alias("n"))
    return c.select(group, (1 - 2 * (F.col("s") - (F.col("a") + F.col("b")) / 2) / F.col("n")).alias("gini"))


def running(table: DataFrame, group: str, value: str, *order: str) -> DataFrame:
    """Add ``place`` (from 1) and ``running`` (the sum so far of ``value``; null counts as 0), by ``order`` within each
    group, for groups of any size: rows are sorted by range into many tasks, each adds up its own, and what the
    tasks before hold of the group is added.  The sorted rows are written to the shared folder.  Equal rows by
    ``order`` may come in any order."""
    spark = table.sparkSession
    kept = table.columns
    amount = F.coalesce(F.col(value), F.lit(0))
    ranged = table.repartitionByRange(F.col(group), *order).sortWithinPartitions(group, *order)
    ranged = snapshots.written(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranged")
    parts = ranged.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_s"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    offsets = parts.select(F.col(group).alias("_group"), F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s"))
    own = Window.partitionBy("_part", group).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = ranged.withColumns({"_place": F.count(F.lit(1)).over(own), "_sum": F.sum(amount).over(own)})
    rows = rows.join(offsets, rows[group].eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of")))
    return rows.select(*kept, (F.col("_place") + F.col("_n")).cast("long").alias("place"), (F.col("_sum") + F.col("_s")).alias("running"))


def lorenz_spread(table: DataFrame, group: str, unit: str, value: str) -> DataFrame:
    """As :func:`lorenz`, for groups of any size."""
    rows = running(table, group, value, value, unit)
    whole = table.groupBy(F.col(group).alias("_g")).agg(F.sum(value).alias("_whole"))
    return rows.join(whole, rows[group].eqNullSafe(F.col("_g"))).withColumn("share", F.col("running") / F.col("_whole")).drop("place", "running", "_g", "_whole")


def ordinal_ranks(table: DataFrame, group: str, value: str, *ties: str, spread: bool = False) -> DataFrame:
    """Add ``rank`` from 0 within each group by value, ties by the given columns; with ``spread``, by
    :func:`running`, for groups of any size."""
    if spread:
        return running(table, group, value, value, *ties).withColumn("rank", (F.col("place") - 1).cast("int")).drop("place", "running")
    return table.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(value, *ties)) - 1)


def rank_changes(table: DataFrame, unit: str, value: str, months: int = 1) -> DataFrame:
    """month_id, n, mobility (mean absolute change of rank) and correlation of the ranks of the units that
    a month and the one ``months`` before have both."""
    now = ordinal_ranks(table, "month_id", value, unit).select("month_id", unit, F.col("rank").alias("_now"))
    before = now.select((F.col("month_id") + months).alias("month_id"), unit, F.col("_now").alias("_before"))
    both = now.join(before, ["month_id", unit]).groupBy("month_id")
    varies = (F.stddev_pop("_now") > 0) & (F.stddev_pop("_before") > 0)
    return both.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("_now") - F.col("_before"))).alias("mobility"), F.when(varies, F.corr("_before", "_now")).alias("correlation"))


def rank_correlation(table: DataFrame, group: str, unit: str, x: str, y: str, least: int = 5) -> DataFrame:
    """group, n and rho: correlation of the ranks by x and by y (ties by unit) of the units of a group that
    have both, where there are at least ``least``."""
    both = table.where(F.col(x).isNotNull() & ~F.isnan(F.col(x).cast("double")) & F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double")))
    place = lambda c: F.row_number().over(Window.partitionBy(group).orderBy(c, unit))
    out = both.select(group, place(x).alias("_x"), place(y).alias("_y")).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.corr("_x", "_y").alias("rho"))
    return out.where(F.col("n") >= least)


def implausible(table: DataFrame, unit: str, value: str, months: int = 12, factor: float = 2.5, floor: float = 2000.0) -> DataFrame:
    """unit, month_id, value, median and flag of the last ``months`` rows of each unit up to its last that is
    not 0: flagged where a value is more than ``factor`` times the window's median (or ``floor``).  Units
    with fewer than three such months are left out."""
    last = F.max(F.when(F.col(value) != 0, F.col("month_id"))).over(Window.partitionBy(unit))
    place = F.row_number().over(Window.partitionBy(unit).orderBy(F.desc("month_id")))
    near = table.withColumn("_last", last).where(F.col("month_id") <= F.col("_last")).withColumn("_place", place).where(F.col("_place") <= months)
    window = Window.partitionBy(unit)
    near = near.withColumns({"median": F.percentile(value, 0.5).over(window), "_n": F.count(F.lit(1)).over(window)})
    return near.where("_n >= 3").select(unit, "month_id", value, "median", (F.col(value) > factor * F.greatest("median", F.lit(floor))).alias("flag"))


def contract_failures(table: DataFrame, unit: str, value: str, today: int, window: int = 12, slo_months: int = 3) -> DataFrame:
    """unit, last_month (with a value other than 0), age, and whether the unit is absent (all 0 in the last
    ``window`` months) or stale (older than ``slo_months``)."""
    out = table.groupBy(unit).agg(
        F.max(F.when(F.col(value) != 0, F.col("month_id"))).alias("last_month"),
        (F.count(F.when((F.col("month_id") > today - window) & (F.col(value) != 0), 1)) == 0).alias("absent"),
    )
    age = F.lit(today) - F.col("last_month")
    return out.select(unit, "last_month", age.alias("age"), "absent", F.coalesce(age > slo_months, F.lit(True)).alias("stale"))


def largest_jump(table: DataFrame, unit: str, value: str) -> DataFrame:
    """Month and size of each unit's largest absolute change (the earliest of equals)."""
    c = change(table, unit, value).where(F.col("change").isNotNull())
    best = F.max_by(F.struct("month_id", "change"), F.struct(F.abs("change"), -F.col("month_id")))
    return c.groupBy(unit).agg(best.alias("b")).select(unit, F.col("b.month_id").alias("month_id"), F.col("b.change").alias("change"))


def empty_months(table: DataFrame, unit: str, value: str) -> DataFrame:
    """Months between a unit's first and last with data that have none."""
    active = table.where(F.col(value) > 0)
    span = active.groupBy(unit).agg(F.min("month_id").alias("a"), F.max("month_id").alias("b"))
    every = span.select(unit, F.explode(F.sequence("a", "b")).alias("month_id"))
    return every.join(active.select(unit, "month_id"), [unit, "month_id"], "left_anti")


def transitions(table: DataFrame, unit: str, value: str, rtol: float = 1e-6, atol: float = 1e-8) -> DataFrame:
    """Rows whose value is not close to that of the row before."""
    before = F.lag(value).over(Window.partitionBy(unit).orderBy("month_id"))
    return table.withColumn("before", before).where(F.abs(F.col(value) - F.col("before")) > atol + rtol * F.abs("before"))


def persistence(table: DataFrame, unit: str, value: str) -> DataFrame:
    """Share of a unit's rows with a positive value, in percent."""
    return table.groupBy(unit).agg((F.count(F.when(F.col(value) > 0, 1)) * 100 / F.count(F.lit(1))).alias("persistence"))


def last_valid(table: DataFrame, unit: str, value: str) -> DataFrame:
    """Each unit's last value that is not null, and its month."""
    return table.where(F.col(value).isNotNull()).groupBy(unit).agg(F.max("month_id").alias("month_id"), F.max_by(value, "month_id").alias(value))


def moments(table: DataFrame, group: str, value: str) -> DataFrame:
    """n, mean, deviation, median and skewness 3 (mean - median) / deviation of each group."""
    out = table.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.percentile(value, 0.5).alias("median"))
    return out.withColumn("skew", F.try_divide(3 * (F.col("mean") - F.col("median")), F.col("std")))


def quantiles(table: DataFrame, group: str, value: str, at: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95), accuracy: int | None = None) -> DataFrame:
    """Variance and interpolated percentiles (p5, p25, ...) of each group; with ``accuracy``, approximate
    ones from bounded sketches, for groups of any size."""
    share = [F.lit(float(p)) for p in at]
    many = F.percentile(value, F.array(*share)) if accuracy is None else F.percentile_approx(value, F.array(*share), accuracy)
    out = table.groupBy(group).agg(F.count(value).alias("n"), F.var_pop(value).alias("variance"), many.alias("_p"))
    return out.select(group, "n", "variance", *[F.col("_p")[i].alias(f"p{100 * p:g}") for i, p in enumerate(at)])


def sketches(table: DataFrame, keys: Sequence[str], feature: str, unit: str, lg_k: int = 12, k: int = 400) -> DataFrame:
    """keys, feature, n, and two sketches of the rows of each of ``keys`` that can be stored and merged: of the
    distinct units with a value other than 0 (``cells``), and of the values' distribution (``spread``)."""
    value = F.when(~F.isnan(F.col(feature).cast("double")), F.col(feature).cast("double"))
    return table.groupBy(*keys).agg(
        F.lit(feature).alias("feature"),
        F.count(value).alias("n"),
        F.hll_sketch_agg(F.when(value != 0, F.col(unit)), lg_k).alias("cells"),
        F.kll_sketch_agg_double(value, k).alias("spread"),
    )


def merged(stored: DataFrame, keys: Sequence[str] = (), at: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """keys, feature, n, n_cells and percentiles (p5, p25, ...) of stored sketches put together: no row is read again.

    With the default sizes n_cells is within 5 % of the exact number and a percentile's rank within 1.5 % of
    its own, nearly always (three standard errors).
    """
    out = stored.groupBy(*keys, "feature").agg(F.sum("n").alias("n"), F.hll_union_agg("cells").alias("_cells"), F.kll_merge_agg_double("spread").alias("_spread"))
    share = lambda p: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_spread", F.lit(float(p)))).alias(f"p{100 * p:g}")
    return out.select(*keys, "feature", "n", F.hll_sketch_estimate("_cells").alias("n_cells"), *[share(p) for p in at])


def log_scaled(value: Column, low: float, high: float) -> Column:
    """log(1 + value) of a value held between two bounds; null stays null."""
    held = F.when(value.isNotNull(), F.least(F.greatest(value.cast("double"), F.lit(float(low))), F.lit(float(high))))
    return F.log1p(held)


def place_label(lat: Column, lon: Column, regions: Mapping[str, tuple[float, float, float, float]] | None = None) -> Column:
    """The first region (south, north, west, east) that holds a point, else whole degrees with N or S and E
    or W."""
    degrees = lambda v, positive, negative: F.concat(F.format_string("%.0f", F.rint(F.abs(v))), F.lit("\u00b0"), F.when(v >= 0, positive).otherwise(negative))
    out = F.concat(degrees(lat, "N", "S"), F.lit(", "), degrees(lon, "E", "W"))
    for name, (south, north, west, east) in reversed((regions or {}).items()):
        out = F.when(lat.between(south, north) & lon.between(west, east), F.lit(name)).otherwise(out)
    return out
