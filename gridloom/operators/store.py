"""The append-only event store: tagging, appending new vintages, upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METADATA = ("_source_type", "_source_version", "_ingested_at", "_harvest_digest", "_harvest_timestamp")


def tag(batch: DataFrame, source_type: str, source_version: str, ingested_at: str, digest: str, harvested_at: str) -> DataFrame:
    """Add the five metadata columns to a batch."""
    return batch.withColumns(dict(zip(METADATA, map(F.lit, (source_type, source_version, ingested_at, digest, harvested_at)), strict=True)))


def untag(store: DataFrame) -> DataFrame:
    return store.drop(*METADATA)


def append(store: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name; a column that one side lacks is null there, differing types are an error."""
    theirs = dict(batch.dtypes)
    clash = [c for c, t in store.dtypes if theirs.get(c, t) != t and "void" not in (t, theirs[c])]
    if clash:
        raise ValueError(f"columns of differing types: {clash}")
    return store.unionByName(batch, allowMissingColumns=True)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def new_vintages(batch: DataFrame, store: DataFrame, keys: Sequence[str] = ("id", "_source_type", "_source_version", "_harvest_digest")) -> DataFrame:
    """Rows of a batch whose keys the store has not; null keys equal each other, repeats in the batch stay."""
    return batch.join(store.select(*keys).distinct(), _same(batch, store, keys), "left_anti") if batch is not store else batch.limit(0)


def latest_per_key(rows: DataFrame, key: str, timestamp: str, *ties: Column) -> DataFrame:
    """One row for each key: the latest, and the first by ``ties`` of equally late ones."""
    order = Window.partitionBy(key).orderBy(F.col(timestamp).desc_nulls_last(), *ties)
    return rows.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def upsert_latest(store: DataFrame, batch: DataFrame, key: str, timestamp: str) -> DataFrame:
    """The store with rows of the batch that are new or strictly later.

    A null timestamp is earliest.  Both sides have one row a key (see :func:`latest_per_key`); a key that is
    there twice on a side is an error when the rows are computed.  Null keys are one key.
    """
    held = lambda df, name: F.struct(*[F.col(c) for c in df.columns]).alias(name)
    one = lambda df, name: df.groupBy(F.col(key).alias("_key")).agg(F.first(held(df, name)).alias(name), F.count(F.lit(1)).alias(f"{name}_n"))
    both = one(store, "_old").join(one(batch, "_new").withColumnRenamed("_key", "_key2"), F.col("_key").eqNullSafe(F.col("_key2")), "full_outer")
    twice = F.greatest(F.coalesce("_old_n", F.lit(1)), F.coalesce("_new_n", F.lit(1))) > 1
    fault = F.raise_error(F.concat(F.lit(f"{key} is there twice: "), F.coalesce(F.col("_key").cast("string"), F.col("_key2").cast("string"), F.lit("null")))).cast("boolean")
    new, old = F.col(f"_new.{timestamp}"), F.col(f"_old.{timestamp}")
    later = F.when(twice, fault).otherwise(F.col("_new_n").isNotNull() & (F.col("_old_n").isNull() | F.coalesce(new > old, F.lit(False)) | (old.isNull() & new.isNotNull())))
    types = dict(batch.dtypes)
    pick = lambda c: F.when(F.col("_later"), F.col(f"_new.{c}") if c in types else F.lit(None)).otherwise(F.col(f"_old.{c}") if c in store.columns else F.lit(None))
    columns = [*store.columns, *[c for c in batch.columns if c not in store.columns]]
    return both.withColumn("_later", later).select(*[pick(c).alias(c) for c in columns])


def harvest_index(ledger: DataFrame) -> DataFrame:
    """Digest and time of each version's last successful ledger row."""
    good = ledger.where(F.col("outcome").isin("success", "unchanged", "cached"))
    return good.groupBy("version").agg(F.max_by("content_digest", "timestamp").alias("content_digest"), F.max("timestamp").alias("timestamp"))


def manifest(store: DataFrame, date: str) -> DataFrame:
    """Rows, first and last date of each version; empty dates are skipped."""
    value = F.when(F.col(date) != "", F.col(date)) if dict(store.dtypes)[date] == "string" else F.col(date)
    return store.groupBy("_source_type", "_source_version").agg(F.count(F.lit(1)).alias("n_events"), F.min(value).alias("first"), F.max(value).alias("last"))
