"""The spatial axis (a global grid of square cells) and the time axis (months since 1980).

Cells are numbered from 1 at the south-west corner, row by row.  Month 1 is January 1980.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH_YEAR = 1980


@dataclass(frozen=True)
class GridConfig:
    resolution: float = 0.5

    def __post_init__(self) -> None:
        if self.resolution <= 0 or 180 % self.resolution:
            raise ValueError("the resolution must be positive and divide 180")

    @property
    def rows(self) -> int:
        return int(180 / self.resolution)

    @property
    def columns(self) -> int:
        return int(360 / self.resolution)

    @property
    def cells(self) -> int:
        return self.rows * self.columns


GRID = GridConfig()


def valid_point(lat: Column, lon: Column) -> Column:
    """Whether a point lies on the grid; the north edge and the date line's east side do not."""
    inside = (lat >= -90) & (lat < 90) & (lon >= -180) & (lon < 180)
    return F.coalesce(inside & ~F.isnan(lat) & ~F.isnan(lon), F.lit(False))


def latlon_to_pgid(lat: Column, lon: Column, grid: GridConfig = GRID) -> Column:
    """Cell of a point; null off the grid, for null and for NaN."""
    row = F.floor((lat + 90) / grid.resolution)
    column = F.floor((lon + 180) / grid.resolution)
    return F.when(valid_point(lat, lon), (row * grid.columns + column + 1).cast("int"))


def pgid_row(pgid: Column, grid: GridConfig = GRID) -> Column:
    """Row of a cell from the south, from 0."""
    return F.floor((pgid - 1) / grid.columns).cast("int")


def pgid_column(pgid: Column, grid: GridConfig = GRID) -> Column:
    return F.pmod(pgid - 1, F.lit(grid.columns)).cast("int")


def pgid_to_lat(pgid: Column, grid: GridConfig = GRID) -> Column:
    """Latitude of a cell's centre; null off the grid."""
    return F.when(pgid.between(1, grid.cells), pgid_row(pgid, grid) * grid.resolution - 90 + grid.resolution / 2)


def pgid_to_lon(pgid: Column, grid: GridConfig = GRID) -> Column:
    return F.when(pgid.between(1, grid.cells), pgid_column(pgid, grid) * grid.resolution - 180 + grid.resolution / 2)


def bounding_box(pgid: Column, grid: GridConfig = GRID) -> Column:
    """Struct of south, west, north, east."""
    half = grid.resolution / 2
    lat, lon = pgid_to_lat(pgid, grid), pgid_to_lon(pgid, grid)
    return F.struct((lat - half).alias("south"), (lon - half).alias("west"), (lat + half).alias("north"), (lon + half).alias("east"))


def month_id(date: Column, epoch: int = EPOCH_YEAR) -> Column:
    return ((F.year(date) - epoch) * 12 + F.month(date)).cast("int")


def month_start(month: Column) -> Column:
    """First day of a month id."""
    return F.add_months(F.lit(f"{EPOCH_YEAR}-01-01").cast("date"), (month - 1).cast("int"))


def month_id_from_text(text: Column) -> Column:
    """Month of a YYYY-MM-DD text; null unless digits and month are in order (the day is not looked at)."""
    month = F.substring(text, 6, 2).try_cast("int")
    year = F.substring(text, 1, 4).try_cast("int")
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & month.between(1, 12), (year - EPOCH_YEAR) * 12 + month)


def parse_month(value: int | str, end: bool = False) -> int:
    """Month id of an id, 'YYYY' (January, or December for an end), 'YYYY-MM' or 'YYYY-MM-DD'."""
    if isinstance(value, int):
        return value
    found = re.fullmatch(r"(\d{4})(?:-(\d{2})(?:-\d{2})?)?", value)
    month = int(found[2]) if found and found[2] else 12 if end else 1
    if not found or not 1 <= month <= 12:
        raise ValueError(f"no month: {value!r}")
    return (int(found[1]) - EPOCH_YEAR) * 12 + month


def parse_time_range(start: int | str | None, end: int | str | None, first: int, last: int) -> tuple[int, int]:
    """Inclusive month ids; None is the axis' end.  An empty overlap with the axis is an error."""
    low = first if start is None else parse_month(start)
    high = last if end is None else parse_month(end, end=True)
    if low > high or high < first or low > last:
        raise ValueError(f"{start!r} to {end!r} does not meet months {first} to {last}")
    return max(low, first), min(high, last)


def cells(spark: SparkSession, grid: GridConfig = GRID) -> DataFrame:
    """pgid, lat, lon of every cell."""
    ids = spark.range(1, grid.cells + 1).select(F.col("id").cast("int").alias("pgid"))
    return ids.select("pgid", pgid_to_lat(F.col("pgid"), grid).alias("lat"), pgid_to_lon(F.col("pgid"), grid).alias("lon"))


def spine(months: DataFrame, units: DataFrame) -> DataFrame:
    """Every month with every unit.  Months are an axis of some hundreds of rows, so they are broadcast."""
    return units.crossJoin(F.broadcast(months))


def months_between(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("month_id"))
