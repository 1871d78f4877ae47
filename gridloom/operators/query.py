"""The query: region x time x features in one of three formats."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import axes

FORMATS = ("cells", "country_month", "feature_frame")


def region_cells(regions: DataFrame, names: Sequence[str], column: str = "region") -> DataFrame:
    """Distinct pgids of named regions; exact names first, else without case; unknown names are an error."""
    known = [r[0] for r in regions.select(column).distinct().collect()]  # names of regions, a short list
    wanted: list[str] = []
    for name in names:
        hits = [k for k in known if k == name] or [k for k in known if k is not None and k.lower() == name.lower()]
        if not hits:
            raise ValueError(f"unknown region {name!r}")
        wanted += hits
    return regions.where(F.col(column).isin(wanted)).select("pgid").distinct()


def resolve_region(name: str, countries: DataFrame, specials: Mapping[str, DataFrame] | None = None, macros: Mapping[str, Sequence[str]] | None = None, column: str = "country") -> DataFrame:
    """Distinct pgids of a region: a special set (a table of pgids), else a macro region (a list of country
    names as written; absent ones warn), else a country by exact name, else without case, else an error.

    ``countries`` has pgid and the country's name.
    """
    specials, macros = specials or {}, macros or {}
    if name in specials:
        return specials[name].select("pgid").distinct()
    if name in macros:
        members = list(macros[name])
        inside = countries.where(F.col(column).isin(members))
        found = {r[0] for r in inside.select(column).distinct().collect()}  # at most the members
        missing = [m for m in members if m not in found]
        if missing:
            warnings.warn(f"region {name!r}: no cells of {missing}", stacklevel=2)
        return inside.select("pgid").distinct()
    try:
        return region_cells(countries, [name], column)
    except ValueError:
        raise ValueError(f"unknown region {name!r}; there are {sorted([*specials, *macros])} and countries") from None


def nonzero(features: Sequence[str]) -> Column:
    """Whether any feature is not 0; NaN counts, null does not."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c) != 0, F.lit(False)) for c in features])


def country_month(cells: DataFrame, features: Sequence[str], types: Mapping[str, str] | None = None, country: str = "country_id") -> DataFrame:
    """Sums over the cells of each country and month; cells without country (0 or less) are left out.

    ``types`` says what each feature is: extensive ones are summed, static ones dropped, and an intensive
    one is an error.  NaN and null count as 0.
    """
    types = types or {}
    wrong = [f for f in features if types.get(f) == "intensive"]
    if wrong:
        raise ValueError(f"intensive features have no sum: {wrong}")
    summed = [f for f in features if types.get(f) != "static"]
    value = lambda c: F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    inside = cells.where(F.col(country) > 0) if dict(cells.dtypes)[country] != "string" else cells.where(F.col(country).isNotNull())
    return inside.groupBy("month_id", country).agg(*[F.sum(value(f)).alias(f) for f in summed])


def excluded(cells: DataFrame, features: Sequence[str], country: str = "country_id") -> DataFrame:
    """One row on the cell months without country (null, 0 or less) that :func:`country_month` leaves out:
    n_excluded, n_with_mass (those whose features add up to more than 0) and each feature's sum."""
    value = lambda c: F.nanvl(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    outside = cells.where(F.col(country).isNull() if dict(cells.dtypes)[country] == "string" else F.coalesce(F.col(country), F.lit(0)) <= 0)
    mass = reduce(lambda a, b: a + b, [value(f) for f in features], F.lit(0.0))
    sums = [F.coalesce(F.sum(value(f)), F.lit(0.0)).alias(f) for f in features]
    return outside.agg(F.count(F.lit(1)).alias("n_excluded"), F.count(F.when(mass > 0, 1)).alias("n_with_mass"), *sums)


def feature_frame(cells: DataFrame, features: Sequence[str]) -> DataFrame:
    """time, unit and the features as one array of floats."""
    return cells.select(F.col("month_id").cast("int").alias("time"), F.col("pgid").cast("int").alias("unit"), F.array(*[F.col(c).cast("float") for c in features]).alias("features"))


def load(
    table: DataFrame,
    features: Sequence[str],
    region: DataFrame | None = None,
    start: int | str | None = None,
    end: int | str | None = None,
    axis: tuple[int, int] = (1, 1200),
    output: str = "cells",
    sparse: bool = False,
    country: str = "country_id",
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of a wide table by region (a table of pgids), months and features.

    The month and feature selections reach the scan, and the years of a cube with ``year`` its
    partitions; the region is a semi-join.
    """
    if output not in FORMATS:
        raise ValueError(f"unknown format {output!r}; there are {FORMATS}")
    unknown = [f for f in features if f not in table.columns]
    if unknown or len(set(features)) != len(features):
        raise ValueError(f"unknown or repeated features: {unknown or list(features)}")
    low, high = axes.parse_time_range(start, end, *axis)
    extra = [country] if output == "country_month" else []
    if "year" in table.columns and "year" not in features:  # what cubes are partitioned by
        table = table.where(F.col("year").between((low - 1) // 12 + axes.EPOCH_YEAR, (high - 1) // 12 + axes.EPOCH_YEAR))
    rows = table.where(F.col("month_id").between(low, high)).select("month_id", "pgid", *extra, *features)
    if region is not None:
        rows = rows.join(region, "pgid", "left_semi")
    if sparse:
        rows = rows.where(nonzero(features))
    if output == "country_month":
        return country_month(rows, features, types, country)
    return feature_frame(rows, features) if output == "feature_frame" else rows.select("month_id", "pgid", *features)


def pre_coverage(first_months: Mapping[str, int], start: int) -> list[str]:
    """Features that begin after the first month asked for."""
    return sorted(f for f, m in first_months.items() if start < m)
