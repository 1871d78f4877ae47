"""Totals that must hold: conservation over a selection, and reconciliation over a hierarchy."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(seen: Observation) -> dict[str, object] | None:
    """What an observation has counted after an action; None where the plan was known to be empty, so that
    nothing ran and nothing was counted."""
    try:
        return seen.get
    except Py4JJavaError:
        return None


def totals(rows: DataFrame, features: Sequence[str], inside: Column) -> DataFrame:
    """One row: for each feature its total over all rows, over those inside and over those outside."""
    out = []
    for f in features:
        out += [
            F.coalesce(F.sum(f), F.lit(0)).alias(f"{f}_all"),
            F.coalesce(F.sum(F.when(inside, F.col(f))), F.lit(0)).alias(f"{f}_inside"),
            F.coalesce(F.sum(F.when(~inside, F.col(f))), F.lit(0)).alias(f"{f}_outside"),
        ]
    return rows.agg(*out)


def assert_conserved(rows: DataFrame, features: Sequence[str], inside: Column, rtol: float = 1e-6, atol: float = 1e-4) -> None:
    """Raise ValueError where inside and outside do not add up to all."""
    row = totals(rows, features, F.coalesce(inside, F.lit(False))).head()
    for f in features:
        whole, parts = float(row[f"{f}_all"]), float(row[f"{f}_inside"]) + float(row[f"{f}_outside"])
        if abs(whole - parts) > atol + rtol * abs(whole):
            raise ValueError(f"{f}: {whole} in all, {parts} in parts")


def nesting_violations(table: DataFrame, fine: str, coarse: str) -> DataFrame:
    """Fine units that lie in more than one coarse unit, with their number."""
    return table.groupBy(fine).agg(F.countDistinct(coarse).alias("n_parents")).where("n_parents > 1")


def level_totals(table: DataFrame, levels: Sequence[str], value: str) -> DataFrame:
    """Totals at every level of a hierarchy (coarsest first), and over all: a rollup."""
    return table.rollup(*levels).agg(F.sum(value).alias("total"), F.grouping_id().alias("level"))


def assert_reconciled(table: DataFrame, levels: Sequence[str], value: str, rtol: float = 1e-6) -> None:
    """Raise ValueError unless every level's totals add up to the same sum, and levels nest."""
    for coarse, fine in zip(levels, levels[1:]):
        bad = nesting_violations(table, fine, coarse).limit(5).collect()
        if bad:
            raise ValueError(f"{fine} in several {coarse}: {[r[fine] for r in bad]}")
    sums = [r["s"] for r in level_totals(table, levels, value).groupBy("level").agg(F.sum("total").alias("s")).collect()]
    if sums and max(sums) - min(sums) > rtol * max(1.0, abs(max(sums))):
        raise ValueError(f"levels differ: {sums}")
