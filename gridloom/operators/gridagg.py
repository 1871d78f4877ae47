"""Events and rasters to grid cells and months, sparse: a row for each (month, cell) with data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import axes


@dataclass(frozen=True)
class FeatureSpec:
    """A feature: an aggregation over the rows whose columns equal the filter's values."""

    name: str
    aggregation: str = "count"
    value: str | None = None
    filter: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.aggregation not in AGGREGATIONS:
            raise ValueError(f"unknown aggregation {self.aggregation!r}; there are {sorted(AGGREGATIONS)}")
        if self.aggregation != "count" and not self.value:
            raise ValueError(f"{self.name}: {self.aggregation} needs a value column")

    def column(self) -> Column:
        chosen = F.lit(True)
        for name, value in self.filter.items():
            chosen = chosen & (F.col(name) == F.lit(value))
        return AGGREGATIONS[self.aggregation](chosen, F.col(self.value) if self.value else None).alias(self.name)


#: Aggregations by name: (condition, value) to a column.  Nulls count as 0, rows that fail as absent.
AGGREGATIONS = {
    "count": lambda c, v: F.count(F.when(c, 1)),
    "sum_field": lambda c, v: F.coalesce(F.sum(F.when(c, F.coalesce(v, F.lit(0)))), F.lit(0)),
    "max_field": lambda c, v: F.coalesce(F.max(F.when(c, F.coalesce(v, F.lit(0)))), F.lit(0)),
}
AGGREGATIONS["sum_best"], AGGREGATIONS["max_best"] = AGGREGATIONS["sum_field"], AGGREGATIONS["max_field"]


def place(events: DataFrame, first: int, last: int, month: Column, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Add pgid and month_id (null off the time axis)."""
    month = F.when(month.between(first, last), month)
    return events.withColumns({"pgid": axes.latlon_to_pgid(F.col(lat), F.col(lon)), "month_id": month})


def accounting(placed: DataFrame) -> DataFrame:
    """One row: n_input = n_placed + skipped_spatial + skipped_temporal (space is looked at first)."""
    spatial, temporal = F.col("pgid").isNull(), F.col("month_id").isNull()
    return placed.agg(
        F.count(F.lit(1)).alias("n_input"),
        F.count(F.when(~spatial & ~temporal, 1)).alias("n_placed"),
        F.count(F.when(spatial, 1)).alias("skipped_spatial"),
        F.count(F.when(~spatial & temporal, 1)).alias("skipped_temporal"),
    )


def compile_grid(placed: DataFrame, features: Sequence[FeatureSpec]) -> DataFrame:
    """(month_id, pgid, features): one aggregation for all features; a bin with any event has them all."""
    needed = {c for f in features for c in [*f.filter, *([f.value] if f.value else [])]}
    missing = sorted(needed - set(placed.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return placed.where(F.col("pgid").isNotNull() & F.col("month_id").isNotNull()).groupBy("month_id", "pgid").agg(*[f.column() for f in features])


def last_value_wins(rows: DataFrame, features: Sequence[str], ordinal: Column) -> DataFrame:
    """(month_id, pgid, features) of long rows: for each feature the last value that is no NaN."""
    kept = lambda c: F.when(~F.isnan(F.col(c)), F.col(c))
    order = lambda c: F.when(kept(c).isNotNull(), ordinal)
    return rows.groupBy("month_id", "pgid").agg(*[F.max_by(kept(c), order(c)).alias(c) for c in features])


def raster_blocks(pixels: DataFrame, block: int, row_offset: int = 0, column_offset: int = 0, nodata: float | None = None, masked: bool = True) -> DataFrame:
    """(block_row, block_col, value): sums of pixels (row, col, value) in blocks; nodata as 0, negatives too if masked."""
    value = F.when(F.col("value") < 0, 0).otherwise(F.col("value")) if masked else F.col("value")
    if nodata is not None:
        value = F.when(F.col("value") == nodata, 0).otherwise(value)
    at = lambda c, o: F.floor((F.col(c) + o) / block).cast("int")
    return pixels.groupBy(at("row", row_offset).alias("block_row"), at("col", column_offset).alias("block_col")).agg(F.sum(value.cast("double")).alias("value"))


def raster_block_to_pgid(row: Column, column: Column, grid: axes.GridConfig = axes.GRID) -> Column:
    """Cell of a block; raster row 0 is the north, grid row 0 the south."""
    return ((grid.rows - 1 - row) * grid.columns + column + 1).cast("int")
