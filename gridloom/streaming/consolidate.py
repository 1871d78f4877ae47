"""Incremental consolidation: a stream of landed snapshots into an append-only store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import store as ops
from ..sources import snapshots

KEYS = ("id", "_source_type", "_source_version", "_harvest_digest")


def append_new(store_path: str, keys: Sequence[str] = KEYS):
    """A foreachBatch function that appends the rows whose keys the store has not; replays change nothing."""

    def batch(rows: DataFrame, _: int) -> None:
        store = snapshots.read_store(rows.sparkSession, store_path)
        fresh = rows if store is None else ops.new_vintages(rows, store, keys)
        fresh.write.mode("append").parquet(store_path)

    return batch


def start(spark: SparkSession, landing: str, schema, store_path: str, checkpoint: str, keys: Sequence[str] = KEYS) -> StreamingQuery:
    """Consolidate what lies in a landing folder, and end."""
    stream = spark.readStream.schema(schema).parquet(landing)
    return stream.writeStream.foreachBatch(append_new(store_path, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def monthly_counts(stream: DataFrame, timestamp: str, key: str, late: str = "31 days") -> DataFrame:
    """month (its first day), event_type and count, each key once within the watermark; a running count, so
    the output mode is update or complete."""
    seen = stream.withWatermark(timestamp, late).dropDuplicatesWithinWatermark([key])
    return seen.groupBy(F.trunc(F.col(timestamp).cast("date"), "MM").alias("month"), "event_type").count()
