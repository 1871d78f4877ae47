"""Ledgers: append-only JSON lines of what was harvested and when."""

from __future__ import annotations

import time
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import snapshots

SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("content_digest", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("ledger_version", T.IntegerType()),
        T.StructField("digest_algorithm", T.StringType()),
        T.StructField("n_events", T.LongType()),
    ]
)


def read(spark: SparkSession, path: str, rotated: bool = True) -> DataFrame:
    """Ledger rows, with those of rotated files; malformed lines are skipped (see :func:`skipped`)."""
    reader = spark.read.schema(SCHEMA).option("mode", "DROPMALFORMED")
    return reader.option("recursiveFileLookup", rotated).option("pathGlobFilter", "*.json*").json(path)


def skipped(spark: SparkSession, path: str) -> int:
    """Number of lines that :func:`read` skips; warns where there are any."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*").text(path).where(F.trim("value") != "")
    n = lines.where(F.from_json("value", T.StructType([*SCHEMA.fields, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad"})["_bad"].isNotNull()).count()
    if n:
        warnings.warn(f"{path}: {n} malformed lines are skipped", stacklevel=2)
    return n


def append(rows: DataFrame, path: str, most_bytes: int | None = None) -> None:
    """Add rows as a file of their own, so that writers do not meet; a ledger of more than ``most_bytes`` is
    rotated first."""
    if most_bytes is not None:
        rotate(rows.sparkSession, path, most_bytes)
    rows.coalesce(1).write.mode("append").json(path)


def rotate(spark: SparkSession, path: str, most_bytes: int) -> str | None:
    """Move a ledger's files to a folder of their own where they have more than ``most_bytes``; that folder."""
    target, fs = snapshots._path(spark, path)
    if not fs.exists(target):
        return None
    files = [s for s in fs.listStatus(target) if s.isFile() and s.getPath().getName().endswith(".json")]
    if sum(s.getLen() for s in files) <= most_bytes:
        return None
    aside, _ = snapshots._path(spark, f"{path}/rotated-{time.strftime('%Y%m%dT%H%M%SZ', time.gmtime())}-{uuid.uuid4().hex[:8]}")
    fs.mkdirs(aside)
    for status in files:
        fs.rename(status.getPath(), snapshots._path(spark, f"{aside.toString()}/{status.getPath().getName()}")[0])
    return aside.toString()
