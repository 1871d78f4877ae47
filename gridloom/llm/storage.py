"""Where intermediate tables live: the folder that driver and executors share."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import threading
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


_here = threading.local()


def _written() -> list[str]:
    """Paths that this thread has written; queries of other threads have their own."""
    return _here.__dict__.setdefault("paths", [])


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where it is unset, a session whose executors run in this process (tests) gets a local folder; on a
    cluster that would be a folder of one machine, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        jsc = spark.sparkContext._jsc.sc()
        if jsc.getCheckpointDir().isDefined():
            return jsc.getCheckpointDir().get()
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written().append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and a lost
    executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def mark() -> int:
    """A point in time for :func:`drop_since`."""
    return len(_written())


def drop_since(spark: SparkSession, point: int, *kept: DataFrame) -> None:
    """Delete the tables that this thread has written since ``point``, but for those that ``kept`` read."""
    needed = {f for df in kept for f in df.inputFiles()}
    for path in _written()[point:]:
        name = path.rsplit("/", 1)[-1]
        if not any(f"/{name}/" in f for f in needed):
            drop_table(spark, path)
            _written().remove(path)


def clear(spark: SparkSession) -> None:
    """Delete all tables that operators have written in this thread; results not computed yet are lost."""
    drop_since(spark, 0)


TEXT_ROWS = 1024


def small_batches(df: DataFrame) -> DataFrame:
    """The same table; from now on the session sends Python at most :data:`TEXT_ROWS` rows at a time.

    Rows here carry whole texts, so the default of ten thousand would be as large as texts are long.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= TEXT_ROWS:
        conf.set(key, str(TEXT_ROWS))
    return df


def trim_memory() -> None:
    """Give back to the system what earlier tasks have left free in this worker process, which tasks of other
    stages use again."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
