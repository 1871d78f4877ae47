"""Rows of a query and of its SQL, made comparable."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = path if os.path.isfile(path) else f"{path}/*.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def _cell(v) -> str:
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return "null"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    try:
        return f"{float(v):.6g}" if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(_cell, r)) for r in frame.itertuples(index=False, name=None))


def compare(spark, sf: str, query, sql: str) -> None:
    ours = query(spark, sf).toPandas()
    theirs = connect(sf).execute(sql).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    a, b = rows(ours), rows(theirs)
    assert len(a) == len(b), (len(a), len(b), list(set(a) - set(b))[:3], list(set(b) - set(a))[:3])
    different = [(x, y) for x, y in zip(a, b) if x != y]
    assert not different, different[:3]
