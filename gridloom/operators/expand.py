"""Row-generating operators: events to months and cells, years to months."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import snapshots
from . import interp

AMOUNTS = ("best", "low", "high")


#: Temporal rules as expressions: (events, months of the span) to whether a row is split, and how shares are rounded.
TEMPORAL: dict[str, tuple[Callable[[DataFrame, Column], Column], Callable[[Column], Column] | None]] = {
    "date_end_only": (lambda events, span: F.lit(False), None),
    "even_split": (lambda events, span: F.col("date_prec") == 5 if "date_prec" in events.columns else F.lit(False), None),
    "ceil_split": (lambda events, span: (F.col("best") > 0) & (span > 1) & (F.col("best") >= span), F.ceil),
    "floor_split": (lambda events, span: (F.col("best") > 0) & (span > 1) & (F.col("best") >= span), F.floor),
}
#: Temporal rules as table functions of events, partitioned by id.
TABLE_RULES: dict[str, object] = {}


def date_accounting(events: DataFrame) -> DataFrame:
    """One row: n_input = n_dated + n_undated + n_reversed; reversed ones end in a month before their first."""
    start, end = F.coalesce("date_start", "date_end"), F.coalesce("date_end", "date_start")
    back = F.trunc(end, "MM") < F.trunc(start, "MM")
    return events.agg(
        F.count(F.lit(1)).alias("n_input"),
        F.count(F.when(end.isNotNull() & ~back, 1)).alias("n_dated"),
        F.count(F.when(end.isNull(), 1)).alias("n_undated"),
        F.count(F.when(back, 1)).alias("n_reversed"),
    )


def split_months(events: DataFrame, rule: str, amounts: Sequence[str] = AMOUNTS, by_source: Mapping[str, str] | None = None) -> DataFrame:
    """Rows by month: ``date_month`` and the amounts of each.

    Rules: ``date_end_only`` (the end's month), ``even_split`` (date_prec 5 over all its months, in
    fractions), ``ceil_split`` and ``floor_split`` (summaries, i.e. best at least the number of months and
    that over 1, rounded up or down for each month).  ``by_source`` names a rule for each source type;
    ``rule`` holds for the others.  Rows without any date are dropped (:func:`date_accounting` counts
    them); a row that is to be split and ends before it begins is an error when it is computed.
    """
    start, end = F.coalesce("date_start", "date_end"), F.coalesce("date_end", "date_start")
    first, last = F.trunc(start, "MM"), F.trunc(end, "MM")
    span = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start) + 1
    rules = {n: F.coalesce(condition(events, span), F.lit(False)) for n, (condition, _) in TEMPORAL.items()}
    known = sorted({*rules, *TABLE_RULES})
    if rule not in known:
        raise KeyError(f"unknown rule {rule!r}; there are {known}")
    name = F.lit(rule)
    for source, other in (by_source or {}).items():
        if other not in known:
            raise KeyError(f"unknown rule {other!r}; there are {known}")
        name = F.when(F.col("_source_type") == source, other).otherwise(name)
    split = F.lit(False)
    for each, condition in rules.items():
        split = F.when(name == each, condition).otherwise(split)
    dated = events.where(end.isNotNull()).withColumn("_rule", name)
    functions = sorted({rule, *(by_source or {}).values()} & TABLE_RULES.keys())
    rows = dated.where(~F.col("_rule").isin(functions)) if functions else dated
    rows = rows.withColumn("_n", F.when(split, span).otherwise(1))
    backwards = F.raise_error(F.lit("an event that is to be split ends before it begins")).cast("array<date>")
    months = F.when(F.col("_n") < 1, backwards).when(F.col("_n") > 1, F.sequence(first, last, F.expr("interval 1 month"))).otherwise(F.array(last))
    rows = rows.withColumn("date_month", F.explode(months))
    for a in amounts:
        share = F.col(a) / F.col("_n")
        rounded = share
        for n, (_, whole) in TEMPORAL.items():
            rounded = F.when(F.col("_rule") == n, whole(share).cast("double")).otherwise(rounded) if whole else rounded
        rows = rows.withColumn(a, F.when(F.col("_n") > 1, rounded).otherwise(F.col(a).cast("double")))
    rows = rows.drop("_rule", "_n")
    for function in functions:
        own = dated.where(F.col("_rule") == function).drop("_rule")
        split_rows = TABLE_RULES[function](own.asTable().partitionBy("id"))
        rows = rows.unionByName(split_rows.select(*[F.col(c).cast(t) for c, t in rows.dtypes]))
    return rows


def weight_map(events: DataFrame, polygons: DataFrame, amount: str = "best", most_precise: int = 3) -> DataFrame:
    """code, pgid and share of each polygon's amount, from well-located events.

    ``polygons`` has pgid and code, and level where there are several.  A polygon whose total is 0 has
    equal shares over its cells.
    """
    keys = [c for c in ("level", "code") if c in polygons.columns]
    totals = events.where(F.col("where_prec") <= most_precise).groupBy(F.col("priogrid_gid").alias("pgid")).agg(F.sum(amount).alias("amount"))
    cells = polygons.join(totals, "pgid", "left").withColumn("amount", F.coalesce("amount", F.lit(0)))
    whole = Window.partitionBy(*keys)
    total, n = F.sum("amount").over(whole), F.count(F.lit(1)).over(whole)
    share = F.when(total > 0, F.col("amount") / total).otherwise(1 / n)
    return cells.select(*keys, "pgid", share.cast("double").alias("share")).where("share > 0")


def allocate(rows: DataFrame, value: str, share: str, keys: Sequence[str], *order: Column) -> Column:
    """Whole-number allocation of ``value`` by ``share`` within ``keys``: floors, and the remainder one
    by one by descending share.  Sums to the value exactly."""
    ranked = Window.partitionBy(*keys).orderBy(F.col(share).desc(), *order)
    whole = Window.partitionBy(*keys)
    floor = F.floor(F.col(value) * F.col(share))
    rest = F.col(value) - F.sum(floor).over(whole)
    n, rank = F.count(F.lit(1)).over(whole), F.row_number().over(ranked)
    return (floor + F.floor(rest / n) + F.when(rank <= F.pmod(rest, n), 1).otherwise(0)).cast("long")


def _at_polygons(events: DataFrame, known: DataFrame, least_precise: int, country_from: int) -> DataFrame:
    """Events with what ``known`` (_at, _code, ..., and _level where there are levels) says of their cell, null where
    they are located well or nothing is known."""
    vague = F.coalesce(F.col("where_prec") >= least_precise, F.lit(False)) & (F.coalesce("priogrid_gid", F.lit(0)) > 0)
    at = vague & (F.col("priogrid_gid") == F.col("_at"))
    if "_level" in known.columns:
        at = at & (F.col("_level") == F.when(F.col("where_prec") >= country_from, 0).otherwise(1))
    return events.join(known, at, "left")


def _ranked_cells(weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each polygon's cells (to, share) as one array ``_cells``, by descending share."""
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("share")).alias("order"), F.col("pgid").alias("to"), "share")))
    return weights.groupBy(*[F.col(k).alias(f"_w{k}") for k in keys]).agg(ranked.alias("_cells"))


def _rest(value: Column) -> Column:
    return value - F.aggregate("_cells", F.lit(0).cast("long"), lambda sum_, c: sum_ + F.floor(value * c["share"]))


def _part(value: Column, share: Column, rest: Column, n: Column, rank: Column) -> Column:
    """What a cell gets, the ``rank``-th of n from 0."""
    return F.floor(value * share) + F.floor(rest / n) + F.when(rank < F.pmod(rest, n), 1).otherwise(0)


def distribute(events: DataFrame, weights: DataFrame, codes: DataFrame, amounts: Sequence[str] = AMOUNTS, least_precise: int = 4, country_from: int = 6) -> DataFrame:
    """Imprecisely located events over their polygon's cells by weight; others, and those without polygon,
    as they are.

    ``codes`` has pgid and code, ``weights`` code, pgid and share.  Where both have ``level``, rows of a
    where_prec from ``country_from`` on go by level 0 and the others by level 1.  Amounts are spread as
    whole numbers (fractions are cut off, null is 0) that add up exactly: floors, and the remainder one by
    one by descending share.  Adds ``_spatial_distributed``, ``_spatial_share``, ``_spatial_source_pgid``,
    ``_spatial_polygon_code`` and ``_spatial_n_cells``.

    A polygon's cells (at most the grid's) are one array, so an event is allocated within its row and
    only then takes several rows: events are not shuffled.
    """
    keys = ["level", "code"] if "level" in codes.columns else ["code"]
    out = _at_polygons(events, codes.select(F.col("pgid").alias("_at"), *[F.col(k).alias(f"_{k}") for k in keys]), least_precise, country_from)
    arrays = _ranked_cells(weights, keys)
    same = F.col("_code") == F.col("_wcode")
    out = out.join(arrays, same & (F.col("_level") == F.col("_wlevel")) if len(keys) > 1 else same, "left")
    whole = {a: F.coalesce(F.col(a), F.lit(0)).cast("long") for a in amounts}
    out = out.withColumns({f"_rest_{a}": _rest(v) for a, v in whole.items()} | {"_spatial_n_cells": F.when(F.col("_cells").isNotNull(), F.size("_cells"))})
    out = out.select("*", F.posexplode_outer("_cells").alias("_i", "_cell"))
    moved = F.col("_cell").isNotNull()
    n, share = F.col("_spatial_n_cells"), F.col("_cell.share")
    part = lambda a: _part(whole[a], share, F.col(f"_rest_{a}"), n, F.col("_i"))
    return (
        out.withColumns({a: F.when(moved, part(a).cast("long")).otherwise(F.col(a)) for a in amounts})
        .withColumns({
            "_spatial_distributed": moved,
            "_spatial_share": share,
            "_spatial_source_pgid": F.when(moved, F.col("priogrid_gid")),
            "_spatial_polygon_code": F.when(moved, F.col("_code")),
        })
        .withColumn("priogrid_gid", F.coalesce("_cell.to", "priogrid_gid"))
        .drop("_at", "_cells", "_i", "_cell", *[f"_{k}" for k in keys], *[f"_w{k}" for k in keys], *[f"_rest_{a}" for a in amounts])
    )


def distribute_totals(events: DataFrame, weights: DataFrame, codes: DataFrame, by: Sequence[str] = (), amounts: Sequence[str] = AMOUNTS, least_precise: int = 4, country_from: int = 6, staying: Column | None = None) -> DataFrame:
    """``by``, priogrid_gid, sums of the amounts and ``n``, the number of rows, of what :func:`distribute` gives,
    without making its rows (an event has as many as its polygon has cells).

    Events of the same polygon, amounts and ``by`` are one group with a count, written to the shared folder; each
    polygon's amounts are allocated once.  An amount leaves something in as many cells as it is large at most, and
    only those become rows; that events also are in the others (with 0) is counted by polygon and ``by``.
    ``staying`` filters the events that are not distributed.
    """
    keys = ["level", "code"] if "level" in codes.columns else ["code"]
    sizes = weights.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    known = codes.join(F.broadcast(sizes), keys)  # a row for each polygon; those without weights are as unknown
    known = known.select(F.col("pgid").alias("_at"), *[F.col(k).alias(f"_{k}") for k in keys], "_n")
    named, values = [f"_{k}" for k in keys], [f"_v_{a}" for a in amounts]
    moved = F.col("_n").isNotNull()
    rows = _at_polygons(events, known, least_precise, country_from)
    rows = rows if staying is None else rows.where(moved | staying)
    # one row of _moved = false for each cell that events stay in, and one of true for each polygon and its amounts
    groups = rows.groupBy(
        *by,
        moved.alias("_moved"),
        F.when(~moved, F.col("priogrid_gid")).alias("_cell"),
        *named,
        *[F.when(moved, F.coalesce(F.col(a), F.lit(0)).cast("long")).alias(v) for a, v in zip(amounts, values, strict=True)],
    ).agg(F.count(F.lit(1)).alias("_m"), *[F.sum(F.when(~moved, F.col(a))).alias(f"_sum_{a}") for a in amounts])
    groups = snapshots.written(groups, "groups")
    kinds = dict(groups.dtypes)
    stay, go = groups.where("not _moved"), groups.where("_moved")
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    each = go.select(*named, *values).distinct().repartition(tasks)
    same = [F.col(f"_{k}") == F.col(f"_w{k}") for k in keys]
    each = each.join(_ranked_cells(weights, keys), same).withColumns({f"_rest_{a}": _rest(F.col(f"_v_{a}")) for a in amounts})
    part = lambda a, c, i: _part(F.col(f"_v_{a}"), c["share"], F.col(f"_rest_{a}"), F.size("_cells"), i).cast("long").alias(f"_p_{a}")
    parts = F.transform("_cells", lambda c, i: F.struct(c["to"].alias("to"), *[part(a, c, i) for a in amounts]))
    some = lambda p: reduce(lambda x, y: x | y, [p[f"_p_{a}"] != 0 for a in amounts])
    each = each.select(*named, *values, F.filter(parts, some).alias("_parts"))
    # inline would have a filter on the size pushed down, with the rest in it for each cell
    got = go.join(each, [*named, *values]).select(*by, "_m", F.inline_outer("_parts")).where(F.col("to").isNotNull())
    got = got.select(*by, F.col("to").alias("priogrid_gid"), *[(F.col("_m") * F.col(f"_p_{a}")).cast(kinds[f"_sum_{a}"]).alias(a) for a in amounts], F.lit(0).cast("long").alias("n"))

    present = go.groupBy(*by, *named).agg(F.sum("_m").alias("_m"))
    cells = weights.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("pgid").alias("priogrid_gid")).repartition(tasks, "priogrid_gid")
    zero = [F.lit(0).cast(kinds[f"_sum_{a}"]).alias(a) for a in amounts]
    there = cells.join(present, named).select(*by, "priogrid_gid", *zero, F.col("_m").alias("n"))

    stays = stay.select(*by, F.col("_cell").alias("priogrid_gid"), *[F.col(f"_sum_{a}").alias(a) for a in amounts], F.col("_m").alias("n"))
    return stays.unionByName(got).unionByName(there).groupBy(*by, "priogrid_gid").agg(*[F.sum(a).alias(a) for a in amounts], F.sum("n").alias("n"))


def last_of_year(values: DataFrame, key: str, value: str, order: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(key, year, value): the value that comes last by ``order`` where a key has a year more than once;
    years outside ``first`` to ``last`` and null values are left out."""
    rows = values.where(F.col(value).isNotNull())
    rows = rows if first is None else rows.where(F.col("year") >= first)
    rows = rows if last is None else rows.where(F.col("year") <= last)
    return rows.groupBy(key, "year").agg(F.max_by(value, order).alias(value))


def years_to_cells(values: DataFrame, months: DataFrame, crosswalk: DataFrame, key: str, value: str, how: str = "linear") -> DataFrame:
    """(pgid, month_id, value) for the months from each key's first year to its last, in all its cells;
    years between that a key lacks are filled by ``how`` ("linear" or "step")."""
    if how not in ("linear", "step"):
        raise ValueError(f"no interpolation {how!r}; there are ['linear', 'step']")
    at = values.where(F.col(value).isNotNull())
    january = ((F.col("year") - 1980) * 12 + 1).cast("int")
    if how == "linear":
        filled = interp.linear(at, months, key, value)
    else:
        filled = interp.step(at.select(key, january.alias("month_id"), value), months, key, value)
    spans = at.groupBy(key).agg(F.min(january).alias("_a"), (F.max(january) + 11).alias("_b"))
    inside = filled.join(spans, key).where(F.col("month_id").between(F.col("_a"), F.col("_b")))
    cells = crosswalk.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return inside.join(cells, key).select("pgid", "month_id", value)


def years_to_months(values: DataFrame, crosswalk: DataFrame, key: str, year: str = "year") -> DataFrame:
    """Rows (key, year, values...) as (pgid, month_id, values...) for the twelve months and all cells of a
    key.  ``crosswalk`` has pgid and the key, without null or empty ones."""
    cells = crosswalk.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    months = values.withColumn("month_id", F.explode(F.sequence(((F.col(year) - 1980) * 12 + 1).cast("int"), ((F.col(year) - 1980) * 12 + 12).cast("int"))))
    return months.join(cells, key).drop(key, year)


#: Spatial rules: (rows by month, current rows of the store, polygons or None) to rows.
SPATIAL: dict[str, Callable[[DataFrame, DataFrame, DataFrame | None], DataFrame]] = {
    "passthrough": lambda rows, current, polygons: rows,
    "proportional": lambda rows, current, polygons: rows if polygons is None else distribute(rows, weight_map(current, polygons), polygons),
}
