"""Validation and comparison: rules on rows, snapshots against each other, grid invariants."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import axes

# Event types of the second event source, and grid rows (from the south) of continents.
EVENT_TYPES = ("Battles", "Explosions/Remote violence", "Violence against civilians", "Protests", "Riots", "Strategic developments")
CONTINENT_ROWS = {"Africa": (110, 255), "Europe": (250, 325), "Asia": (180, 340), "Americas": (70, 350)}


def violations(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """rule and n_violations for each rule (a condition that rows should meet; null is a violation)."""
    failed = [F.count(F.when(~F.coalesce(c, F.lit(False)), 1)).alias(name) for name, c in rules.items()]
    one = rows.agg(*failed)
    return one.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, rules)), F.array(*[F.col(f"`{n}`") for n in rules]))).alias("rule", "n_violations"))


def assert_schema(rows: DataFrame, required: Mapping[str, str]) -> None:
    """Raise ValueError for missing columns or other types."""
    have = dict(rows.dtypes)
    wrong = {c: (t, have.get(c)) for c, t in required.items() if have.get(c) != t}
    if wrong:
        raise ValueError(f"columns (wanted, found): {wrong}")


def event_rules() -> dict[str, Column]:
    """What every event should meet: ordered amounts, known codes, valid coordinates and dates."""
    c = F.col
    return {
        "amounts_ordered": (c("low") <= c("best")) & (c("best") <= c("high")),
        "best_not_negative": c("best") >= 0,
        "violence_known": c("type_of_violence").between(1, 3),
        "location_precision_known": c("where_prec").between(1, 7),
        "date_precision_known": c("date_prec").between(1, 5),
        "latitude_valid": c("latitude").between(-90, 90),
        "longitude_valid": c("longitude").between(-180, 180),
        "dates_ordered": c("date_start") <= c("date_end"),
    }


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """key, status (added, removed, revised) and delta of rows that differ; null values count as 0."""
    a = old.select(F.col(key).alias("_a"), F.col(value).alias("_old"), F.lit(1).alias("_in_old"))
    b = new.select(F.col(key).alias("_b"), F.col(value).alias("_new"), F.lit(1).alias("_in_new"))
    joined = a.join(b, F.col("_a") == F.col("_b"), "full_outer")
    delta = F.coalesce("_new", F.lit(0)) - F.coalesce("_old", F.lit(0))
    status = F.when(F.col("_in_old").isNull(), "added").when(F.col("_in_new").isNull(), "removed").when(delta != 0, "revised")
    return joined.select(F.coalesce("_a", "_b").alias(key), status.alias("status"), delta.alias("delta")).where(F.col("status").isNotNull())


def overlapping_spans(spans: DataFrame, name: str) -> DataFrame:
    """Pairs of named spans (name, first, last) of years that share one, by the years they share."""
    years = spans.select(name, F.explode(F.sequence("first", "last")).alias("year"))
    pairs = years.alias("x").join(years.alias("y"), (F.col("x.year") == F.col("y.year")) & (F.col(f"x.{name}") < F.col(f"y.{name}")))
    return pairs.groupBy(F.col(f"x.{name}").alias("left"), F.col(f"y.{name}").alias("right")).agg(F.count(F.lit(1)).alias("n_years"))


def compare_sums(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, rtol: float = 1e-5) -> DataFrame:
    """Keys whose sums differ by more than ``rtol`` of the larger, or stand on one side only."""
    sums = lambda df, name: df.groupBy(*keys).agg(F.sum(value).alias(name))
    joined = sums(left, "left_sum").join(sums(right, "right_sum"), list(keys), "full_outer")
    gap = F.abs(F.col("left_sum") - F.col("right_sum")) > rtol * F.greatest(F.abs("left_sum"), F.abs("right_sum"))
    return joined.where(F.coalesce(gap, F.lit(True)))


def spread_within(table: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Population deviation of a value within groups; 0 where it was broadcast whole."""
    return table.groupBy(*group).agg(F.stddev_pop(value).alias("std"), F.count(F.lit(1)).alias("n"))


def type_sums(table: DataFrame, total: str, parts: Sequence[str]) -> DataFrame:
    """One row: bins, and bins where the parts do not add up to the total."""
    added = sum((F.col(p) for p in parts), F.lit(0))
    return table.agg(F.count(F.lit(1)).alias("n_bins"), F.count(F.when(added != F.col(total), 1)).alias("n_broken"))


def zero_inflation(table: DataFrame, features: Sequence[str], n_cells: int, n_months: int) -> DataFrame:
    """feature, nonzero bins, ever nonzero cells and the share of zeros among all bins of the dense grid."""
    one = table.agg(
        *[F.count(F.when(F.col(f) != 0, 1)).alias(f"n_{f}") for f in features],
        *[F.countDistinct(F.when(F.col(f) != 0, F.col("pgid"))).alias(f"c_{f}") for f in features],
    )
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"n_{f}").alias("n_nonzero"), F.col(f"c_{f}").alias("n_cells")) for f in features])
    out = one.select(F.inline(rows))
    return out.withColumn("zero_share", 1 - F.col("n_nonzero") / (n_cells * n_months))


def last_ledger_rows(ledger: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` ledger rows of each dataset."""
    order = Window.partitionBy("dataset").orderBy(F.desc("timestamp"))
    return ledger.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= n).drop("_nth")


def content_digest(rows: DataFrame, *columns: str) -> DataFrame:
    """One row: a digest that does not depend on the rows' order, and their number."""
    h = F.xxhash64(*columns)
    return rows.agg(F.bit_xor(h).alias("digest_xor"), F.sum(h.cast("decimal(20,0)")).alias("digest_sum"), F.count(F.lit(1)).alias("n"))


def freshness(table: DataFrame, features: Sequence[str], today: int) -> DataFrame:
    """feature, last month with a positive value, and its age in months on month ``today``."""
    one = table.agg(*[F.max(F.when(F.col(f) > 0, F.col("month_id"))).alias(f) for f in features])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("last_month"), (F.lit(today) - F.col(f)).alias("age")) for f in features])
    return one.select(F.inline(rows))


def health(ledger: DataFrame, now: str, n: int = 10) -> DataFrame:
    """dataset, runs and failures among its last ``n`` ledger rows, last success, and days since then."""
    recent = last_ledger_rows(ledger, n)
    good = F.col("outcome") != "failed"
    out = recent.groupBy("dataset").agg(F.count(F.lit(1)).alias("runs"), F.count(F.when(~good, 1)).alias("failures"), F.max(F.when(good, F.col("timestamp"))).alias("last_success"))
    return out.withColumn("days_since", F.date_diff(F.lit(now).cast("date"), F.to_date(F.substring("last_success", 1, 10))))


def changed_keys(old: DataFrame, new: DataFrame, key: str, digest: str) -> DataFrame:
    """key and status (added, removed, changed) of digests that differ; none means a step can be skipped."""
    joined = old.select(F.col(key).alias("_a"), F.col(digest).alias("_x")).join(new.select(F.col(key).alias("_b"), F.col(digest).alias("_y")), F.col("_a") == F.col("_b"), "full_outer")
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("_x").eqNullSafe(F.col("_y")), "changed")
    return joined.select(F.coalesce("_a", "_b").alias(key), status.alias("status")).where(F.col("status").isNotNull())


def typed_rules() -> dict[str, Column]:
    """What every event of the second source should meet; absent values are no violations."""
    rule = lambda name, holds: F.col(name).isNull() | holds(F.col(name))
    return {
        "fatalities_not_negative": rule("fatalities", lambda c: c.cast("double") >= 0),
        "event_type_known": rule("event_type", lambda c: c.isin(*EVENT_TYPES)),
        "latitude_valid": rule("latitude", lambda c: c.between(-90, 90)),
        "longitude_valid": rule("longitude", lambda c: c.between(-180, 180)),
    }


def assert_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    """Raise ValueError where keys repeat."""
    double = rows.groupBy(*keys).count().where("count > 1").limit(5).collect()
    if double:
        raise ValueError(f"repeated {list(keys)}: {[tuple(r)[:-1] for r in double]}")


def assert_same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    """Raise ValueError unless both have the same keys."""
    for a, b, side in ((left, right, "left"), (right, left, "right")):
        only = a.join(b, list(keys), "left_anti").select(*keys).limit(5).collect()
        if only:
            raise ValueError(f"only in the {side}: {[tuple(r) for r in only]}")


def largest_revisions(old: DataFrame, new: DataFrame, key: str, value: str, k: int = 20) -> DataFrame:
    """The k revised keys with the largest absolute change, in that order (ties by key)."""
    revised = snapshot_diff(old, new, key, value).where("status = 'revised'").select(key, "delta")
    return revised.orderBy(F.abs("delta").desc(), key).limit(k)


def parity(ours: DataFrame, theirs: DataFrame, key: str, values: Sequence[str], tolerance: float = 0.01) -> DataFrame:
    """Their rows with ``error`` (the largest absolute difference; null where a value is absent) and status:
    matched within the tolerance, differs, or missing where we have no such key."""
    mine = ours.select(F.col(key).alias("_key"), F.lit(True).alias("_known"), *[F.col(v).alias(f"_{v}") for v in values])
    gaps = [F.abs(F.col(v) - F.col(f"_{v}")) for v in values]
    absent = reduce(lambda a, b: a | b, [g.isNull() for g in gaps])
    error = F.when(~absent, F.greatest(*gaps) if len(gaps) > 1 else gaps[0])
    status = F.when(F.col("_known").isNull(), "missing").when(F.coalesce(F.col("error") <= tolerance, F.lit(False)), "matched").otherwise("differs")
    joined = theirs.join(mine, F.col(key) == F.col("_key"), "left").withColumn("error", error).withColumn("status", status)
    return joined.drop("_key", "_known", *[f"_{v}" for v in values])


def checks(one: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """check and ok for each rule over a table of one row; null is not ok."""
    rows = [F.struct(F.lit(name).alias("check"), F.coalesce(rule, F.lit(False)).alias("ok")) for name, rule in rules.items()]
    return one.select(F.inline(F.array(*rows)))


def _marked(table: DataFrame, land: DataFrame | None) -> DataFrame:
    """Add ``_land``; without a table of land cells all are."""
    if land is None:
        return table.withColumn("_land", F.lit(True))
    cells = land.select("pgid").distinct().withColumn("_land", F.lit(True))
    return table.join(cells, "pgid", "left").withColumn("_land", F.coalesce("_land", F.lit(False)))


def _if(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def event_grid_checks(table: DataFrame, total: str, parts: Sequence[str], land: DataFrame | None = None, annual: tuple[int, int] = (50_000, 500_000)) -> DataFrame:
    """Eight checks of a sparse (month_id, pgid, counts) table, by months, then years, then in one row.

    Under 1 % of events off land, under 100 in the 60 southernmost rows, every year with events within
    ``annual``, no empty month between the first and the last, events in the rows of four continents.
    """
    row, t = axes.pgid_row(F.col("pgid")), F.col(total)
    every = [total, *parts]
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in every])
    negative = reduce(lambda a, b: a | b, [F.col(c) < 0 for c in every])
    one = F.lit(1)
    sums = {"_total": _if(F.lit(True), t), "_bad": _if(bad, one), "_negative": _if(negative, one), "_broken": _if(sum((F.col(p) for p in parts), F.lit(0)) != t, one)}
    sums |= {"_ocean": _if(~F.col("_land"), t), "_south": _if(row < 60, t)}
    sums |= {f"_{name}": _if((row >= a) & (row < b), t) for name, (a, b) in CONTINENT_ROWS.items()}
    months = _marked(table, land).groupBy("month_id").agg(*[c.alias(n) for n, c in sums.items()])
    active = F.when(F.col("_total") > 0, F.col("month_id"))
    spans = [F.count(active).alias("_active"), F.min(active).alias("_first"), F.max(active).alias("_last")]
    years = months.groupBy(F.floor((F.col("month_id") - 1) / 12).alias("_year")).agg(*[F.sum(n).alias(n) for n in sums], *spans)
    off = F.count(F.when((F.col("_total") > 0) & ~F.col("_total").between(*annual), 1)).alias("_off")
    whole = years.agg(*[F.sum(n).alias(n) for n in sums], F.sum("_active").alias("_active"), F.min("_first").alias("_first"), F.max("_last").alias("_last"), off)
    c = F.col
    return checks(
        whole,
        {
            "no_nan": c("_bad") == 0,
            "no_negatives": c("_negative") == 0,
            "type_sum_invariant": c("_broken") == 0,
            "ocean_events_negligible": (c("_total") == 0) | (c("_ocean") * 100 < c("_total")),
            "no_antarctic_events": c("_south") < 100,
            "annual_count_range": c("_off") == 0,
            "no_empty_months": F.coalesce(c("_last") - c("_first") + 1, F.lit(0)) == c("_active"),
            "spatial_extent": sum(((c(f"_{name}") > 0).cast("int") for name in CONTINENT_ROWS), F.lit(0)) >= 4,
        },
    )


def population_checks(table: DataFrame, value: str, known: Mapping[int, float], n_land: int, land: DataFrame | None = None) -> DataFrame:
    """Six checks of a (year, pgid, value) table; those of place look at the last year.

    Under 0.5 % off land, under a million in the 60 southernmost rows, totals within 15 % of the ``known``
    ones of their years, more than 30 % of ``n_land`` cells with a positive value.
    """
    v, row = F.col(value), axes.pgid_row(F.col("pgid"))
    sums = {"_total": _if(F.lit(True), v), "_bad": _if(v.isNull() | F.isnan(v.cast("double")), F.lit(1)), "_negative": _if(v < 0, F.lit(1))}
    sums |= {"_ocean": _if(~F.col("_land"), v), "_south": _if(row < 60, v), "_populated": _if(v > 0, F.lit(1))}
    years = _marked(table, land).groupBy("year").agg(*[c.alias(n) for n, c in sums.items()])
    ratio = F.lit(None).cast("double")
    for year, total in known.items():
        ratio = F.when(F.col("year") == year, F.col("_total") / total).otherwise(ratio)
    last = [F.max_by(n, "year").alias(n) for n in ("_total", "_ocean", "_south", "_populated")]
    whole = years.withColumn("_ratio", ratio).agg(*last, F.sum("_bad").alias("_bad"), F.sum("_negative").alias("_negative"), F.count(F.when(~F.col("_ratio").between(0.85, 1.15), 1)).alias("_off"))
    c = F.col
    return checks(
        whole,
        {
            "no_nan": c("_bad") == 0,
            "no_negatives": c("_negative") == 0,
            "ocean_pop_negligible": (c("_total") <= 0) | (c("_ocean") * 100 < c("_total") * 0.5),
            "no_antarctic_pop": c("_south") < 1_000_000,
            "pop_sanity_vs_known": c("_off") == 0,
            "spatial_coverage": c("_populated") * 100 > 30.0 * n_land,
        },
    )


def built_checks(table: DataFrame, value: str, known: Mapping[int, float], n_land: int, land: DataFrame | None = None) -> DataFrame:
    """Seven checks of a (month_id, pgid, value) table of built-up area, which changes at epochs; those of place
    look at the last month.

    Under 0.5 % off land, under a million in the 60 southernmost rows, more than 5 % of ``n_land`` cells built;
    a month's total that differs (by more than 1e-6 of it) from that of the month before begins an epoch, and
    epochs do not shrink; those that begin in a ``known`` year are within 15 % of it.
    """
    v, row = F.col(value), axes.pgid_row(F.col("pgid"))
    sums = {"_total": _if(F.lit(True), v), "_bad": _if(v.isNull() | F.isnan(v.cast("double")), F.lit(1)), "_negative": _if(v < 0, F.lit(1))}
    sums |= {"_ocean": _if(~F.col("_land"), v), "_south": _if(row < 60, v), "_built": _if(v > 0, F.lit(1))}
    months = _marked(table, land).groupBy("month_id").agg(*[c.alias(n) for n, c in sums.items()])
    order = Window.orderBy("month_id")  # a row a month
    before = F.lag("_total").over(order)
    begins = before.isNull() | (F.abs(F.col("_total") - before) > 1e-8 + 1e-6 * F.abs(before))
    months = months.withColumns({"_begins": begins, "_before": before})
    ratio = F.lit(None).cast("double")
    for year, total in known.items():
        ratio = F.when(F.floor((F.col("month_id") - 1) / 12) + axes.EPOCH_YEAR == year, F.col("_total") / total).otherwise(ratio)
    last = [F.max_by(n, "month_id").alias(n) for n in ("_total", "_ocean", "_south", "_built")]
    whole = months.withColumn("_ratio", F.when(F.col("_begins"), ratio)).agg(
        *last,
        F.sum("_bad").alias("_bad"),
        F.sum("_negative").alias("_negative"),
        F.count(F.when(F.col("_begins") & (F.col("_total") < F.col("_before")), 1)).alias("_shrinks"),
        F.count(F.when(~F.col("_ratio").between(0.85, 1.15), 1)).alias("_off"),
    )
    c = F.col
    return checks(
        whole,
        {
            "no_nan": c("_bad") == 0,
            "no_negatives": c("_negative") == 0,
            "ocean_built_negligible": (c("_total") <= 0) | (c("_ocean") * 100 < c("_total") * 0.5),
            "no_antarctic_built": c("_south") < 1_000_000,
            "monotonic_epoch_growth": c("_shrinks") == 0,
            "spatial_coverage": c("_built") * 100 > 5.0 * n_land,
            "built_area_vs_jrc": c("_off") == 0,
        },
    )


def covariate_checks(table: DataFrame, features: Sequence[str], main: str, n_land: int, land: DataFrame | None = None, low: float = -0.01, high: float = 1.01) -> DataFrame:
    """Five checks of a (month_id, pgid, features) table of yearly covariates.

    All values from ``low`` to ``high``, the last month's land cells with a value of ``main`` more than 30 % of
    ``n_land``, no change of ``main`` within a year, some NaN or null (countries have gaps), and the last
    month's mean of ``main`` between 0.2 and 0.8.
    """
    value = lambda f: F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double"))
    out = reduce(lambda a, b: a | b, [F.coalesce(~value(f).between(low, high), F.lit(False)) for f in features])
    gap = reduce(lambda a, b: a | b, [value(f).isNull() for f in features])
    years = table.groupBy("pgid", F.floor((F.col("month_id") - 1) / 12).alias("_year")).agg((F.max(value(main)) - F.min(value(main)) > 1e-9).alias("_moves"))
    moving = years.agg(F.count(F.when(F.col("_moves"), 1)).alias("_moving"))
    months = _marked(table, land).groupBy("month_id").agg(
        F.count(F.when(out, 1)).alias("_out"), F.count(F.when(gap, 1)).alias("_gaps"), F.count(F.when(F.col("_land"), value(main))).alias("_covered"), F.avg(value(main)).alias("_mean")
    )
    whole = months.agg(F.sum("_out").alias("_out"), F.sum("_gaps").alias("_gaps"), F.max_by("_covered", "month_id").alias("_covered"), F.max_by("_mean", "month_id").alias("_mean"))
    c = F.col
    return checks(
        whole.crossJoin(moving),  # rows of one each
        {
            "values_in_range": c("_out") == 0,
            "coverage_adequate": c("_covered") * 100 > 30.0 * n_land,
            "step_function_holds": c("_moving") == 0,
            "nan_present": c("_gaps") > 0,
            "mean_libdem_reasonable": (c("_mean") > 0.2) & (c("_mean") < 0.8),
        },
    )


def index_checks(table: DataFrame, value: str, low: float = -0.01, high: float = 1.01) -> DataFrame:
    """Three checks of a (month_id, pgid, value) index: some values, all within bounds, one value a cell and year."""
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    years = table.groupBy("pgid", F.floor((F.col("month_id") - 1) / 12).alias("_year")).agg(F.min(v).alias("_a"), F.max(v).alias("_b"))
    whole = years.agg(F.count("_a").alias("_n"), F.min("_a").alias("_low"), F.max("_b").alias("_high"), F.count(F.when(F.col("_a") != F.col("_b"), 1)).alias("_moving"))
    c = F.col
    return checks(whole, {"has_values": c("_n") > 0, "in_range": (c("_low") >= low) & (c("_high") <= high), "constant_in_year": c("_moving") == 0})


def composite_digest(files: DataFrame, group: str, name: str, digest: str) -> DataFrame:
    """group and ``composite``: SHA-256 of its files' digests in the order of their names, joined by ``|``.
    A group has as many entries as a dataset has files."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(name).alias("_name"), F.col(digest).alias("_digest"))))
    return files.groupBy(group).agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["_digest"]), "|"), 256).alias("composite"))


def schema_fingerprint(table: DataFrame) -> str:
    """First 16 hex digits of the SHA-256 of the sorted column names, joined by commas."""
    return hashlib.sha256(",".join(sorted(table.columns)).encode()).hexdigest()[:16]
