"""Versions of snapshots: parsing, ordering, and the versions that file names carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def version_key(version: Column) -> Column:
    """Array of a dotted version's numbers, which compares like a tuple; [0] if a part is no number."""
    parts = F.transform(F.split(F.coalesce(version, F.lit("")), r"\."), lambda p: p.try_cast("int"))
    return F.when(F.exists(parts, lambda p: p.isNull()), F.array(F.lit(0))).otherwise(parts)


def version_from_path(path: Column, kind: str) -> Column:
    """Version in a snapshot's file name: 'annual' (x_v<version>_<y0>_<y1>), 'candidate' or 'dot9'."""
    pattern = {
        "annual": r"_v([0-9.]+)_[0-9]{4}_[0-9]{4}\.parquet$",
        "candidate": r"_candidate_([0-9.]+)\.parquet$",
        "dot9": r"_dot9_([0-9.]+)\.parquet$",
    }[kind]
    found = F.regexp_extract(path, pattern, 1)
    return F.when(found != "", found)


def candidate_versions(year: Column, kind: str = "candidate") -> Column:
    """The twelve versions of a year, '<yy>.0.<m>' or '<yy>.9.<m>'."""
    middle = {"candidate": "0", "dot9": "9"}[kind]
    return F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.concat_ws(".", F.pmod(year, F.lit(100)).cast("string"), F.lit(middle), m.cast("string")))
