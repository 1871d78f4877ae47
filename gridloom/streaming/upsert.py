"""Keyed streaming upserts: the latest row of each event, from vintages that arrive in any order.

Each event's state is the timestamp of its latest row, kept where the event's rows go, so a batch costs what
it brings and never a scan of the store.  Rows that change an event go to a log, one folder a batch;
a batch that is tried again replaces its own folder.  :func:`current` is the latest row of each event over
the log, and :func:`compact` folds the log into the store.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators import store as ops
from ..sources import snapshots

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Latest(StatefulProcessor):
    """Emits a row if it is its key's first or strictly later than all before it; a null timestamp is earliest.

    With ``forget`` (seconds) a timer drops the state of a key that has not changed for so long.  A row that
    comes after that goes to the log even if an earlier one was later; it is no winner there.
    """

    def __init__(self, timestamp: str, kind: T.DataType, forget: int | None = None) -> None:
        self.timestamp, self.kind, self.forget = timestamp, kind, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", T.StructType([T.StructField("at", self.kind, True)]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.latest.exists()
        at = self.latest.get()[0] if known else None
        best = None
        for row in rows:
            t = row[self.timestamp]
            if not known or (t is not None and (at is None or t > at)):
                known, at, best = True, t, row
        if best is not None:
            self.latest.update((at,))
            if self.forget is not None:
                for timer in self.handle.listTimers():
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 1000 * self.forget)
            yield best

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.latest.clear()
        return iter([])

    def close(self) -> None:
        pass


def changes(stream: DataFrame, key: str, timestamp: str, forget: int | None = None) -> DataFrame:
    """The rows of a stream that change the latest row of their key, one a key and batch: of equally late ones
    the first that comes.  Null keys are one key."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    processor = Latest(timestamp, stream.schema[timestamp].dataType, forget)
    return stream.groupBy(key).transformWithState(processor, stream.schema, "Update", "None" if forget is None else "ProcessingTime")


def _append(log: str):
    def batch(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{log}/batch={number}")

    return batch


def start(spark: SparkSession, landing: str, schema: T.StructType, log: str, checkpoint: str, key: str = "id", timestamp: str = "_ingested_at", files: int | None = None) -> StreamingQuery:
    """Take in what lies in a landing folder (``files`` of it a batch), and end.  Timers (``forget`` of :func:`changes`)
    are for queries that go on."""
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files) if files else reader
    out = changes(reader.parquet(landing), key, timestamp)
    return out.writeStream.foreachBatch(_append(log)).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(log: DataFrame, key: str = "id", timestamp: str = "_ingested_at") -> DataFrame:
    """The latest row of each key in a log (with ``batch``): of equally late ones that of the first batch."""
    return ops.latest_per_key(log, key, timestamp, F.col("batch")).drop("batch")


def compact(spark: SparkSession, log: str, store_path: str, schema: T.StructType, key: str = "id", timestamp: str = "_ingested_at") -> DataFrame:
    """Fold a log into the store, which is replaced whole, and return it.  Folding twice changes nothing, so the
    log's folders may be removed afterwards or stay."""
    wide = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    fresh = current(spark.read.schema(wide).parquet(log), key, timestamp)
    held = snapshots.read_store(spark, store_path)
    snapshots.write_store(fresh if held is None else ops.upsert_latest(held, fresh, key, timestamp), store_path)
    return spark.read.parquet(store_path)
