"""Recomputing a cube only where its input has changed.

Three tables beside the cube say what it was made from: a digest for each vintage of the store, a digest
for each month of the resolved rows, and names and sizes of the files of each year.  If all vintages, the
settings and the files are as they were, nothing is computed.  Else the store is resolved (a new vintage
may supersede rows anywhere), and only years with a month whose digest differs, or whose files are not
those that were written, are compiled and written; the files of other years stay.

Digests are sums and exclusive-ors of row hashes, so they do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import changed_keys
from ..sources import snapshots


@dataclass(frozen=True)
class Refresh:
    """What a call has done, and why."""

    reason: str
    changed: tuple[str, ...] = ()
    written: tuple[int, ...] = ()
    removed: tuple[int, ...] = ()

    @property
    def skipped(self) -> bool:
        return not self.written and not self.removed


def _year() -> Column:
    return F.floor((F.col("month_id") - 1) / 12).cast("int") + 1980


def digests(rows: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(key, digest) of each group of rows, over all columns or those named; rows in any order."""
    h = F.xxhash64(*(columns or rows.columns))
    parts = (F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(20,0)")))
    return rows.groupBy(key).agg(F.concat_ws("/", *[p.cast("string") for p in parts]).alias("digest"))


def vintage_digests(store: DataFrame, names: Sequence[str] = ("_source_type", "_source_version")) -> DataFrame:
    """(vintage, digest) of the versions in a store."""
    vintage = F.concat_ws("/", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names])
    return digests(store.withColumn("vintage", vintage), "vintage", store.columns)


def _file_digests(spark: SparkSession, path: str) -> DataFrame:
    found = snapshots.files(spark, path)
    year = F.regexp_extract("file", r"year=(-?[0-9]+)/", 1).cast("int")
    return digests(found.withColumn("year", year), "year", ("file", "bytes"))


def _differing(before: DataFrame, after: DataFrame, key: str) -> list:
    return sorted(r[0] for r in changed_keys(before, after, key, "digest").select(key).collect())


def refresh(store: DataFrame, resolve: Callable[[DataFrame], DataFrame], compile: Callable[[DataFrame], DataFrame], path: str, settings: str = "") -> Refresh:
    """Bring the cube at ``path`` up to date with ``store``.

    ``resolve`` makes rows with month_id from the store, ``compile`` a (month_id, pgid, features) table of any
    whole months of them; ``settings`` stands for all that they depend on besides, and another one means a
    full rebuild.  The tables of digests lie in ``<path>.inputs`` and are replaced last, so a run that fails
    is made good by the next.  Null months are left out.
    """
    vintages = vintage_digests(store).persist(StorageLevel.DISK_ONLY)  # compared and recorded, of one scan
    try:
        return _refresh(store, vintages, resolve, compile, path, settings)
    finally:
        vintages.unpersist()


def _refresh(store: DataFrame, vintages: DataFrame, resolve: Callable[[DataFrame], DataFrame], compile: Callable[[DataFrame], DataFrame], path: str, settings: str) -> Refresh:
    spark = store.sparkSession
    inputs = f"{path}.inputs"
    before = _recorded(spark, inputs) if snapshots.exists(spark, path) else None
    if before is None:
        reason, changed = "no previous run", ()
    elif before["settings"] != settings:
        reason, changed, before = "other settings", (), None
    else:
        changed = tuple(_differing(before["vintages"], vintages, "vintage"))
        broken = _differing(before["files"], _file_digests(spark, path), "year")
        if not changed and not broken:
            return Refresh("same vintages and files")
        reason = "other vintages" if changed else "other files"
    rows = resolve(store).where(F.col("month_id").isNotNull()).persist(StorageLevel.DISK_ONLY)
    months = digests(rows, "month_id").persist(StorageLevel.DISK_ONLY)
    try:
        here = {r[0] for r in months.select(_year()).distinct().collect()}
        if before is None:
            snapshots.write_cube(compile(rows), path)
            written, removed = here, set()
        else:
            affected = {(m - 1) // 12 + 1980 for m in _differing(before["months"], months, "month_id")} | set(broken)
            written, removed = affected & here, affected - here
            if affected:
                snapshots.write_years(compile(rows.where(_year().isin(sorted(written)))), path, sorted(written), sorted(removed))
        _record(spark, inputs, settings, vintages, months, _file_digests(spark, path))
    finally:
        months.unpersist()
        rows.unpersist()
    return Refresh(reason, changed, tuple(sorted(written)), tuple(sorted(removed)))


def _recorded(spark: SparkSession, inputs: str) -> dict | None:
    if not snapshots.exists(spark, inputs):
        return None
    rows = spark.read.schema("kind string, key string, digest string").parquet(inputs)
    of = lambda kind, key, as_: rows.where(F.col("kind") == kind).select(F.col("key").cast(as_).alias(key), "digest")
    settings = of("settings", "key", "string").head()
    return {"settings": settings and settings["digest"], "vintages": of("vintage", "vintage", "string"), "months": of("month", "month_id", "int"), "files": of("year", "year", "int")}


def _record(spark: SparkSession, inputs: str, settings: str, vintages: DataFrame, months: DataFrame, files: DataFrame) -> None:
    """All digests in one table, so that they change together."""
    kind = lambda df, kind, key: df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), "digest")
    rows = kind(spark.createDataFrame([("", settings)], "key string, digest string"), "settings", "key")
    for df, name, key in ((vintages, "vintage", "vintage"), (months, "month", "month_id"), (files, "year", "year")):
        rows = rows.unionByName(kind(df, name, key))
    snapshots.write_store(rows, inputs)
