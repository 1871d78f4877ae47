"""Snapshots and stores as files: landed JSON pages, CSV tables, parquet stores with atomic replacement."""

from __future__ import annotations

import csv
import io
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Parquet with the columns asked for; missing ones are an error."""
    table = spark.read.parquet(path)
    missing = sorted(set(columns) - set(table.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return table.select(*columns)


def read_store(spark: SparkSession, path: str) -> DataFrame | None:
    """A store, or None where there is none yet."""
    return spark.read.parquet(path) if exists(spark, path) else None


def replace(spark: SparkSession, path: str, write: Callable[[str], None], check: Callable[[], object] | None = None) -> None:
    """Replace what is at ``path``: ``write`` puts the new beside it, then it is renamed.  The old one stays
    until the new is complete and ``check`` has passed, and comes back if the new one cannot take its place."""
    beside = f"{path}.new-{uuid.uuid4().hex}"
    new, fs = _path(spark, beside)
    try:
        write(beside)
        if check is not None:
            check()
    except Exception:
        fs.delete(new, True)
        raise
    target, _ = _path(spark, path)
    old, _ = _path(spark, f"{path}.old-{uuid.uuid4().hex}")
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        raise OSError(f"{path} cannot be moved")
    try:
        moved = fs.rename(new, target)
    except Exception:
        moved = False
        raise
    finally:
        if not moved and replaced:
            fs.rename(old, target)
    if not moved:
        raise OSError(f"{path} cannot be written")
    if replaced:
        fs.delete(old, True)


def write_store(table: DataFrame, path: str, check: Callable[[], object] | None = None) -> None:
    """Replace a store (see :func:`replace`)."""
    replace(table.sparkSession, path, table.write.parquet, check)


def write_events(batches: Sequence[DataFrame], path: str) -> None:
    """A snapshot of all batches' events with all their fields, sorted by name, null where a batch lacks one;
    no events at all is an error, and leaves what was there."""
    if not batches or all(b.isEmpty() for b in batches):
        raise ValueError("no events to save")
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
    write_store(every.select(*sorted(every.columns)), path)


def archive(spark: SparkSession, path: str, stamp: str) -> str:
    """Move a snapshot to archive/<name>_<stamp> beside it."""
    target, fs = _path(spark, path)
    folder, _ = _path(spark, f"{target.getParent().toString()}/archive")
    fs.mkdirs(folder)
    moved, _ = _path(spark, f"{folder.toString()}/{target.getName()}_{stamp}")
    if not fs.rename(target, moved):
        raise OSError(f"{path} cannot be moved")
    return moved.toString()


def read_pages(spark: SparkSession, path: str, schema: T.StructType, results: str = "Result") -> DataFrame:
    """Events of landed API pages: JSON objects with an array of events each."""
    envelope = T.StructType([T.StructField(results, T.ArrayType(schema))])
    return spark.read.schema(envelope).json(path, multiLine=True).select(F.inline(results))


def assert_complete(pages: DataFrame, total: str, results: str = "Result", share: float = 0.01, number: int = 1100) -> int:
    """Number of events on landed pages (with the count that the source stated, ``total``); raise ValueError where
    they fall short of it by more than ``share`` of it and by more than ``number``."""
    one = pages.agg(F.coalesce(F.sum(F.size(results)), F.lit(0)).alias("n"), F.max(total).alias("stated")).head()
    short = (one["stated"] or 0) - one["n"]
    if short > number and short > share * one["stated"]:
        raise ValueError(f"{one['stated']} events are stated and {one['n']} are there: {short} are missing")
    return one["n"]


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header, only the columns asked for.  With a schema (of columns of the file, in any order) the
    files are read once and a column's type does not depend on what is in them."""
    if schema is not None:
        missing = sorted(set(columns) - set(schema.fieldNames()))
        if missing:
            raise ValueError(f"missing columns: {missing}")
        names = spark.read.csv(path, header=True).columns  # the header alone
        missing = sorted(set(columns) - set(names))
        if missing:
            raise ValueError(f"missing columns: {missing}")
        kinds = {f.name: f.dataType for f in schema.fields}
        whole = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
        return spark.read.csv(path, header=True, schema=whole, enforceSchema=False).select(*columns)
    table = spark.read.csv(path, header=True, inferSchema=True)
    missing = sorted(set(columns) - set(table.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return table.select(*columns)


def read_zipped_csv(spark: SparkSession, path: str, schema: T.StructType, member: str = ".csv") -> DataFrame:
    """The schema's columns of the CSV members (names ending in ``member``) of landed ZIP files; a file
    without such a member, or a member without one of the columns, is an error.  A task streams a file's
    members, so only the packed bytes are held."""
    names = schema.fieldNames()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as packed:
                    found = sorted(n for n in packed.namelist() if n.lower().endswith(member.lower()))
                    if not found:
                        raise ValueError(f"{at} has no member {member}")
                    for name in found:
                        with packed.open(name) as raw:
                            lines = csv.DictReader(io.TextIOWrapper(raw, "utf-8-sig", newline=""))
                            missing = sorted(set(names) - set(lines.fieldnames or ()))
                            if missing:
                                raise ValueError(f"{name} in {at} lacks columns: {missing}")
                            held = []
                            for line in lines:
                                held.append([line[n] or None for n in names])
                                if len(held) == 10_000:
                                    yield pd.DataFrame(held, columns=names, dtype=object)
                                    held = []
                            if held:
                                yield pd.DataFrame(held, columns=names, dtype=object)

    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    spread = files.repartition("path").mapInPandas(rows, texts)
    return spread.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_static(spark: SparkSession, path: str, value: str, cell: str = "gid") -> DataFrame:
    """(pgid, value) of a landed static covariate, a JSON array of objects with a cell and a value; a cell
    that is there twice is an error when the rows are read."""
    schema = T.StructType([T.StructField(cell, T.LongType()), T.StructField("value", T.DoubleType())])
    one = spark.read.schema(schema).json(path, multiLine=True).where(F.col(cell).isNotNull())
    cells = one.groupBy(F.col(cell).cast("int").alias("pgid")).agg(F.max("value").alias(value), F.count(F.lit(1)).alias("_n"))
    fault = F.raise_error(F.concat(F.lit("cell is there twice: "), F.col("pgid").cast("string"))).cast("boolean")
    return cells.where(F.when(F.col("_n") == 1, True).otherwise(fault)).drop("_n")


def read_geojson(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """Polygons and multipolygons as (properties..., outer ring of x and y, holes as such rings)."""
    shape = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    feature = T.StructType([T.StructField("properties", properties), T.StructField("geometry", shape)])
    features = spark.read.schema(T.StructType([T.StructField("features", T.ArrayType(feature))])).json(path, multiLine=True).select(F.inline("features"))
    one = F.from_json("geometry.coordinates", "array<array<array<double>>>")
    many = F.from_json("geometry.coordinates", "array<array<array<array<double>>>>")
    polygons = F.when(F.col("geometry.type") == "Polygon", F.array(one)).when(F.col("geometry.type") == "MultiPolygon", many)
    outer = features.where(polygons.isNotNull()).select("properties.*", F.explode(polygons).alias("_p"))
    ring = lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    holes = F.transform(F.slice("_p", F.lit(2), F.size("_p")), ring)
    return outer.withColumns({"ring": ring(F.element_at("_p", 1)), "holes": holes}).drop("_p")


def by_year(table: DataFrame) -> DataFrame:
    """A (month_id, pgid, features) table with its year, dealt so that a year is written by as many tasks as its
    months and cells take."""
    year = F.floor((F.col("month_id") - 1) / 12).cast("int") + 1980
    return table.withColumn("year", year).repartitionByRange("month_id", "pgid").sortWithinPartitions("month_id", "pgid")


def write_cube(table: DataFrame, path: str) -> None:
    """A (month_id, pgid, features) table by year, so that time ranges read their own files only; replaced
    whole (see :func:`replace`)."""
    replace(table.sparkSession, path, by_year(table).write.partitionBy("year").parquet)


def write_years(table: DataFrame, path: str, years: Sequence[int], gone: Sequence[int] = ()) -> None:
    """Replace these years of a cube and remove those that are ``gone``; files of other years are not touched."""
    rows = by_year(table).where(F.col("year").isin(list(years)))
    rows.write.partitionBy("year").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    for year in gone:
        folder, fs = _path(table.sparkSession, f"{path}/year={year}")
        fs.delete(folder, True)


def files(spark: SparkSession, path: str) -> DataFrame:
    """file (below ``path``) and bytes of the parquet files in a folder; their contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return found.select(F.regexp_replace("path", ".*/" + re.escape(path.rstrip("/").rsplit("/", 1)[-1]) + "/", "").alias("file"), F.col("length").alias("bytes"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share, ``spark.checkpoint.dir``; a local session
    without that setting gets a folder of its own, a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(table: DataFrame, name: str) -> DataFrame:
    """The table as files in the shared folder: its lineage ends there."""
    spark = table.sparkSession
    path = scratch(spark, name)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)
