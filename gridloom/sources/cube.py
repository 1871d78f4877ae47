"""Cubes as blocks of months and cells, with zone maps beside them.

A block is a row: some months of a tile of cells, the places in it that have data (``at``) and an array of
values for each feature.  Features are columns, so a scan reads those asked for.  Files lie by months and
band of tiles; a table of zones (least, greatest, sum and number of each block's values of each feature) says
which blocks a query can meet before any of them is opened, and has the totals without reading any.

A cube's folder holds versions and a file that names the current one.  A version is written and its sums are
compared with the source's before the name is swapped, so readers see a whole cube, the old or the new.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import axes
from ..operators import conserve
from . import ledger as ledgers
from . import snapshots

POINTER = "CURRENT"
#: Folders that are named one by one to a reader; beyond it the whole version is, with the same filters.
FOLDERS = 2048


@dataclass(frozen=True)
class Layout:
    """Months of a block and cells a side of its tile."""

    months: int = 12
    tile: int = 32

    def block(self, month: Column) -> Column:
        return F.floor((month - 1) / self.months).cast("int")

    def band(self, pgid: Column, grid: axes.GridConfig) -> Column:
        return F.floor(axes.pgid_row(pgid, grid) / self.tile).cast("int")

    def across(self, grid: axes.GridConfig) -> int:
        return -(-grid.columns // self.tile)

    def of_cell(self, pgid: Column, grid: axes.GridConfig) -> Column:
        """Number of a cell's tile."""
        return self.band(pgid, grid) * self.across(grid) + F.floor(axes.pgid_column(pgid, grid) / self.tile).cast("int")

    def place(self, month: Column, pgid: Column, grid: axes.GridConfig) -> Column:
        row, column = F.pmod(axes.pgid_row(pgid, grid), F.lit(self.tile)), F.pmod(axes.pgid_column(pgid, grid), F.lit(self.tile))
        return ((F.pmod(month - 1, F.lit(self.months)) * self.tile + row) * self.tile + column).cast("int")

    def month(self, block: Column, place: Column) -> Column:
        return (block * self.months + F.floor(place / self.tile**2) + 1).cast("int")

    def pgid(self, tile: Column, place: Column, grid: axes.GridConfig) -> Column:
        row = F.floor(tile / self.across(grid)) * self.tile + F.floor(place / self.tile) % self.tile
        column = tile % self.across(grid) * self.tile + place % self.tile
        return (row * grid.columns + column + 1).cast("int")


class SumsDiffer(ValueError):
    """A written cube does not hold what it was given."""


def write(
    table: DataFrame,
    path: str,
    features: Sequence[str],
    types: Mapping[str, str] | None = None,
    layout: Layout = Layout(),  # noqa: B008
    grid: axes.GridConfig = axes.GRID,
    tolerance: float = 0.5,
    ledger: str | None = None,
) -> str:
    """Write a (month_id, pgid, features) table as the cube's next version, make it the current one and return
    its name.

    Values become floats; null and NaN are absent.  A (month, cell) that is there twice, cells off the grid and
    null months are errors, as are sums that differ by more than ``tolerance`` (with a relative 1e-6) from the
    source's: then the cube stays as it was.  ``types`` are the features' aggregation types; with ``ledger``, a row
    is added there.
    """
    spark = table.sparkSession
    value = lambda f: F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double"))
    sums = [F.coalesce(F.sum(value(f)), F.lit(0.0)).alias(f) for f in features]
    seen = Observation()
    rows = table.select("month_id", "pgid", *[value(f).alias(f) for f in features]).observe(seen, *sums)
    off = F.col("month_id").isNull() | ~F.coalesce(F.col("pgid").between(1, grid.cells), F.lit(False))
    fault = F.raise_error(F.lit("a row is off the grid or without month")).cast("int")
    keyed = rows.select(
        F.when(off, fault).otherwise(layout.block(F.col("month_id"))).alias("block"),
        layout.of_cell(F.col("pgid"), grid).alias("tile"),
        F.struct(layout.place(F.col("month_id"), F.col("pgid"), grid).alias("at"), *[F.col(f).cast("float").alias(f) for f in features]).alias("v"),
    )
    blocks = keyed.groupBy("block", "tile").agg(F.sort_array(F.collect_list("v")).alias("v"))  # at most a block's places
    at = F.col("v.at")
    twice = F.raise_error(F.concat_ws(" ", F.lit("a month and cell is there twice in block"), "block", "tile")).cast("array<int>")
    blocks = blocks.select(
        "block",
        F.floor(F.col("tile") / layout.across(grid)).cast("int").alias("band"),
        "tile",
        F.when(F.size(F.array_distinct(at)) == F.size("v"), at).otherwise(twice).alias("at"),
        *[F.col(f"v.`{f}`").alias(f) for f in features],
    )
    version = f"v-{uuid.uuid4().hex}"
    folder = f"{path}/{version}"
    try:
        blocks.repartitionByRange("block", "band", "tile").sortWithinPartitions("block", "band", "tile").write.partitionBy("block", "band").parquet(f"{folder}/blocks")
        _zones(_blocks(spark, folder, features), features).repartition("block").write.parquet(f"{folder}/zones")
        meta = _describe(spark, folder, features, types or {}, layout, grid)
        _compare(meta["sums"], conserve.observed(seen), lambda: table.select(*[value(f).alias(f) for f in features]).agg(*sums).head().asDict(), tolerance)
        _write_text(spark, f"{folder}/cube.json", json.dumps(meta, indent=1))
    except Exception:
        _remove(spark, folder)
        raise
    _swap(spark, path, version)
    if ledger is not None:
        row = (path.rstrip("/").rsplit("/", 1)[-1], version, "success", meta["digest"], None, 1, "xxhash64", meta["n_places"])
        ledgers.append(spark.createDataFrame([row], ledgers.SCHEMA).withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")), ledger)
    return version


def _blocks(spark: SparkSession, folder: str, features: Sequence[str], *parts: str) -> DataFrame:
    """Stored blocks, of some folders of theirs or of all."""
    root = f"{folder}/blocks"
    schema = f"block int, band int, tile int, at array<int>, {', '.join(f'`{f}` array<float>' for f in features)}"
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{p}" for p in parts] or [root])


def _stored_zones(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("feature string, block int, band int, tile int, n int, least float, greatest float, total double, digest long, places int").parquet(f"{folder}/zones")


def _zones(blocks: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature, block, band, tile, n, least, greatest, total of each block with a value."""
    held = lambda f: F.filter(f, lambda x: x.isNotNull())
    total = lambda f: F.aggregate(held(f), F.lit(0.0), lambda s, x: s + x.cast("double"))
    one = lambda f: F.struct(F.lit(f).alias("feature"), F.size(held(f)).alias("n"), F.array_min(held(f)).alias("least"), F.array_max(held(f)).alias("greatest"), total(f).alias("total"))
    digest = F.xxhash64("block", "tile", "at", *features)
    rows = blocks.select("block", "band", "tile", digest.alias("digest"), F.size("at").alias("places"), F.explode(F.array(*[one(f) for f in features])).alias("z"))
    return rows.select("z.feature", "block", "band", "tile", "z.n", "z.least", "z.greatest", "z.total", "digest", "places")


def _describe(spark: SparkSession, folder: str, features: Sequence[str], types: Mapping[str, str], layout: Layout, grid: axes.GridConfig) -> dict:
    zones = _stored_zones(spark, folder)
    sums = {r["feature"]: r["total"] for r in zones.groupBy("feature").agg(F.sum("total").alias("total")).collect()}
    one = zones.select("block", "tile", "digest", "places").distinct()
    digest = one.agg(F.bit_xor("digest").alias("d"), F.coalesce(F.sum("places"), F.lit(0)).alias("n")).head()
    spans = _blocks(spark, folder, features).select("block", *[_span(f, layout) for f in features])
    ends = spans.agg(*[c for f in features for c in (F.min(f"{f}.first").alias(f"{f} first"), F.max(f"{f}.last").alias(f"{f} last"))]).head()
    return {
        "features": {f: {"type": types.get(f), "first_month": ends[f"{f} first"], "last_month": ends[f"{f} last"]} for f in features},
        "sums": {f: sums.get(f) or 0.0 for f in features},
        "layout": asdict(layout),
        "resolution": grid.resolution,
        "digest": f"{(digest['d'] or 0) & (2**64 - 1):016x}",
        "n_places": digest["n"],
    }


def _span(feature: str, layout: Layout) -> Column:
    """First and last month of a block with a value other than 0."""
    months = F.transform(F.filter(F.arrays_zip("at", feature), lambda p: F.coalesce(p[feature] != 0, F.lit(False))), lambda p: layout.month(F.col("block"), p["at"]))
    return F.struct(F.array_min(months).alias("first"), F.array_max(months).alias("last")).alias(feature)


def _compare(stored: Mapping[str, float], source: Mapping[str, float] | None, recount: Callable[[], Mapping[str, float]], tolerance: float) -> None:
    far = lambda a: [f for f in stored if not abs(stored[f] - a[f]) <= tolerance + 1e-6 * abs(a[f])]
    if source is None or far(source):  # tasks that ran twice are observed twice
        source = recount()
    if wrong := far(source):
        raise SumsDiffer("; ".join(f"{f}: {source[f]} given, {stored[f]} stored" for f in wrong))


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    target, fs = snapshots._path(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def _read_text(spark: SparkSession, path: str) -> str:
    target, fs = snapshots._path(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _remove(spark: SparkSession, path: str) -> None:
    target, fs = snapshots._path(spark, path)
    fs.delete(target, True)


def _swap(spark: SparkSession, path: str, version: str) -> None:
    """Replace the pointer by one rename."""
    beside = f"{path}/{POINTER}.{version}"
    _write_text(spark, beside, version)
    jvm = spark.sparkContext._jvm
    new, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (beside, f"{path}/{POINTER}"))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, target, options)


class Cube:
    """The current version of a cube at the time of opening."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        if not snapshots.exists(spark, f"{path}/{POINTER}"):
            raise FileNotFoundError(f"no cube at {path}")
        self.spark, self.path = spark, path
        self.version = _read_text(spark, f"{path}/{POINTER}")
        self.folder = f"{path}/{self.version}"
        self.meta = json.loads(_read_text(spark, f"{self.folder}/cube.json"))
        self.layout, self.grid = Layout(**self.meta["layout"]), axes.GridConfig(self.meta["resolution"])
        self.features = list(self.meta["features"])

    def zones(self) -> DataFrame:
        return _stored_zones(self.spark, self.folder).drop("digest", "places")

    def totals(self) -> DataFrame:
        """feature, n, total, least, greatest of all values, from the zones alone."""
        return self.zones().groupBy("feature").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("greatest").alias("greatest"))

    def load(
        self,
        features: Sequence[str],
        region: DataFrame | None = None,
        start: int | str | None = None,
        end: int | str | None = None,
        above: Mapping[str, float] | None = None,
    ) -> DataFrame:
        """(month_id, pgid, features) of the months and the region's cells (a table of pgids; repeats do not
        matter), with a value in any of the features, or with one above a bound in each of ``above``.

        Only folders of blocks that months, region and bounds meet are opened.  The list of the region's
        tiles goes to the driver: there are no more than the grid has.
        """
        unknown = [f for f in [*features, *(above or {})] if f not in self.features]
        if unknown or len(set(features)) != len(features):
            raise ValueError(f"unknown or repeated features: {unknown or list(features)}")
        low, high = axes.parse_time_range(start, end, 1, 12 * 400)
        met = self.zones().where(F.col("block").between((low - 1) // self.layout.months, (high - 1) // self.layout.months))
        if region is not None:
            tiles = [r[0] for r in region.select(self.layout.of_cell(F.col("pgid"), self.grid).alias("tile")).distinct().where("tile is not null").collect()]
            met = met.where(F.col("tile").isin(tiles))
        keys = met.where(F.col("feature").isin(list(features)) & (F.col("n") > 0)).select("block", "band", "tile").distinct()
        for feature, bound in (above or {}).items():
            keys = keys.join(met.where((F.col("feature") == feature) & (F.col("greatest") > bound)).select("block", "band", "tile"), ["block", "band", "tile"], "left_semi")
        wanted = list(dict.fromkeys([*features, *(above or {})]))
        blocks = self._open(keys, wanted)
        held = F.arrays_zip("at", *wanted)
        rows = blocks.select("block", "tile", F.explode(held).alias("v"))
        rows = rows.select(self.layout.month(F.col("block"), F.col("v.at")).alias("month_id"), self.layout.pgid(F.col("tile"), F.col("v.at"), self.grid).alias("pgid"), *[F.col(f"v.{f}").alias(f) for f in wanted])
        rows = rows.where(F.col("month_id").between(low, high)).where(F.coalesce(*[F.col(f) for f in features]).isNotNull())
        for feature, bound in (above or {}).items():
            rows = rows.where(F.col(feature) > bound)
        if region is not None:
            rows = rows.join(region.select("pgid").distinct(), "pgid", "left_semi")
        return rows.select("month_id", "pgid", *features)

    def _open(self, keys: DataFrame, features: Sequence[str]) -> DataFrame:
        """Blocks by (block, band, tile), from their folders alone."""
        folders = [f"block={r['block']}/band={r['band']}" for r in keys.select("block", "band").distinct().orderBy("block", "band").limit(FOLDERS + 1).collect()]
        blocks = _blocks(self.spark, self.folder, self.features, *(folders if len(folders) <= FOLDERS else ()))
        if not folders:
            blocks = blocks.limit(0)
        return blocks.select("block", "band", "tile", "at", *features).join(F.broadcast(keys) if len(folders) <= 64 else keys, ["block", "band", "tile"], "left_semi")


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Remove all versions but the current one (readers of older ones must have ended); their names."""
    current = Cube(spark, path).version
    target, fs = snapshots._path(spark, path)
    old = sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory() and s.getPath().getName() not in (current,))
    for name in old:
        _remove(spark, f"{path}/{name}")
    return old


def from_feature_frame(frame: DataFrame, features: Sequence[str], start: int, end: int, grid: axes.GridConfig = axes.GRID) -> DataFrame:
    """time, unit and features (an array) as (month_id, pgid, features), with ``placed``: false off the months or
    the grid, where cell and month stay as they are."""
    inside = F.coalesce(F.col("time").between(start, end) & F.col("unit").between(1, grid.cells), F.lit(False))
    held = F.col("features")
    wrong = F.raise_error(F.concat(F.lit("a row has not as many features as names: "), F.size(held).cast("string"))).cast("boolean")
    placed = F.when(F.size(held) == len(features), inside).otherwise(wrong)
    return frame.select(F.col("time").cast("int").alias("month_id"), F.col("unit").cast("int").alias("pgid"), *[held[i].cast("float").alias(f) for i, f in enumerate(features)], placed.alias("placed"))
