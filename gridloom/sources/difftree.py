"""Snapshots in ranges of a hash, with a tree of digests, so that two of them are compared where they differ.

Rows go to ranges by the first bits of their key's hash, a folder each.  Beside them lies a table of digests:
one of each range and, above it, one of each sixteen ranges below, up to the root.  A comparison goes down
from the root, level by level, only below nodes that differ, and reads the ranges it ends at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from . import snapshots

#: Levels below the root; each has sixteen times the nodes of the one above.
LEVELS = 2


def write(rows: DataFrame, path: str, key: str, columns: Sequence[str] | None = None, levels: int = LEVELS) -> None:
    """Replace a snapshot at ``path``; digests are over ``columns`` (all, if none are named).  Rows may come in any
    order and more than once."""
    spark = rows.sparkSession
    width = 4 * levels
    bits = F.shiftrightunsigned(F.xxhash64(key), 64 - width).cast("int") if width else F.lit(0)
    named = rows.columns if columns is None else list(columns)

    def put(folder: str) -> None:
        ranged = rows.withColumn("range", bits)
        spark.createDataFrame([], ranged.schema).coalesce(1).write.parquet(f"{folder}/schema")  # what an empty snapshot has
        ranged.repartition("range").write.partitionBy("range").parquet(f"{folder}/rows")
        stored = spark.read.schema(ranged.schema).parquet(f"{folder}/rows")
        h = F.xxhash64(*named)
        node = stored.groupBy("range").agg(F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n"))
        level = node.select(F.lit(levels).alias("level"), F.col("range").alias("node"), F.concat_ws("/", F.hex("x"), F.col("s").cast("string"), F.col("n").cast("string")).alias("digest"))
        tree = level
        for up in range(levels - 1, -1, -1):
            # a node's digest is of its children's, in order
            children = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("node", "digest"))), lambda c: F.concat_ws(":", c["node"].cast("string"), c["digest"])), ",")
            level = level.groupBy(F.floor(F.col("node") / 16).cast("int").alias("node")).agg(F.sha1(children).alias("digest")).select(F.lit(up).alias("level"), "node", "digest")
            tree = tree.unionByName(level)
        tree.write.parquet(f"{folder}/tree")

    snapshots.replace(spark, path, put)


def _tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("level int, node int, digest string").parquet(f"{path}/tree")


def differing(spark: SparkSession, old: str, new: str) -> list[int]:
    """Ranges in which two snapshots with trees of one depth differ."""
    a, b = _tree(spark, old), _tree(spark, new)
    depths = [t.agg(F.max("level")).head()[0] for t in (a, b)]
    depth = max((d for d in depths if d is not None), default=0)
    if None not in depths and depths[0] != depths[1]:
        raise ValueError(f"trees of {depths[0]} and {depths[1]} levels")
    above: list[int] | None = None
    for level in range(depth + 1):
        below = F.lit(True) if above is None else F.floor(F.col("node") / 16).cast("int").isin(above)
        here = [t.where((F.col("level") == level) & below).select("node", "digest") for t in (a, b)]
        above = sorted(r["node"] for r in quality.changed_keys(*here, "node", "digest").select("node").collect())
        if not above:
            return []
    return above


def read(spark: SparkSession, path: str, ranges: Sequence[int]) -> DataFrame:
    """Rows of some ranges of a snapshot; only their folders are opened."""
    schema = spark.read.parquet(f"{path}/schema").schema
    root = f"{path}/rows"
    folders = [f"{root}/range={r}" for r in ranges if snapshots.exists(spark, f"{root}/range={r}")]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders)


def diff(spark: SparkSession, old: str, new: str, key: str, value: str) -> DataFrame:
    """What ``quality.snapshot_diff`` gives for two snapshots, from the ranges that differ."""
    found = differing(spark, old, new)
    return quality.snapshot_diff(read(spark, old, found), read(spark, new, found), key, value)


