"""Exact top-k inner products by the threshold algorithm.

Vectors are dealt to shards of bounded size, and a task sorts each dimension of its shard once; queries
go to the shards and stream past the lists.  For a query, lists are read from their best end (the
largest components where the query's is positive, the smallest where it is negative), twice as deep
each time; vectors met for the first time are scored in full, and reading stops when the score that
an unseen vector could have at most, the bound, is below the k-th best score so far.  A tie with the
bound reads on, because an unseen vector might tie with a smaller id.

Each query is searched in one shard first, its home; its k-th score there is a floor for it in the
others, so that they can stop without k vectors of their own and return only what may still count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialise

#: Rows of a shard at most (smaller tables have smaller shards, so that all tasks have work), and queries answered at a time.
SHARD_ROWS = 16384
QUERY_ROWS = 2048
STEP = 64
_OUT = "query_id long, vec_id long, score long"
_LONG = np.iinfo(np.int64)


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and ``v``: floor(scale * x) of each component as double, as longs.

    Vectors that are null or hold a null or non-finite component are left out, as are rows without id.
    An empty vector has no components, so all its scores are 0.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return vectors.where(x.isNotNull() & ~bad & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


class Lists:
    """A shard's vectors with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[by_id], rows[by_id]
        columns = np.ascontiguousarray(self.rows.T)
        self.order = np.argsort(columns, axis=1, kind="stable").astype(np.int32)  # ascending lists, one a row
        self.values = np.take_along_axis(columns, self.order, 1)

    def search(self, query: np.ndarray, own: int, k: int, floor=None, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best but ``own``, ties to the smaller id; none below ``floor``."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        seen = self.ids == own
        kept, scores = np.zeros(0, np.int64), np.zeros(0, self.rows.dtype)
        if not len(used):  # every score is 0
            kept = np.flatnonzero(~seen)[:k] if floor is None or floor <= 0 else kept
            return self.ids[kept], np.zeros(len(kept), self.rows.dtype)
        up, down = used[query[used] > 0], used[query[used] < 0]
        at, stop, everything = 0, min(n, step), None
        while at < n:
            met = np.zeros(n, bool)
            met[self.order[up, n - stop : n - at].ravel()] = True
            met[self.order[down, at:stop].ravel()] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            if len(new):
                if everything is None and 4 * len(new) > n:  # one product over all rows costs less than copying so many
                    everything = self.rows @ query
                found = everything[new] if everything is not None else self.rows[new] @ query
                least = scores[-1] if len(kept) == k else floor
                if least is not None:
                    new, found = new[found >= least], found[found >= least]
                if len(new) > k:
                    cut = np.partition(found, len(new) - k)[len(new) - k]
                    new, found = new[found >= cut], found[found >= cut]
                kept, scores = np.append(kept, new), np.append(scores, found)
                best = np.lexsort((kept, -scores))[:k]
                kept, scores = kept[best], scores[best]
            bound = (self.values[up, n - stop] * query[up]).sum() + (self.values[down, stop - 1] * query[down]).sum()
            if (len(kept) == k and scores[-1] > bound) or (floor is not None and floor > bound):
                break
            at, stop = stop, min(n, 2 * stop)
        return self.ids[kept], scores


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _searcher(k: int, width: int, query_rows: int):
    """One shard's rows, then the queries that come to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, lists = [np.zeros(0, np.int64)], [np.zeros((0, width), np.int64)], {}
        for batch in batches:
            asks = batch.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
            held = batch.filter(pa.array(~asks))
            ids.append(held.column("vec_id").to_numpy(zero_copy_only=False))
            rows.append(_matrix(held.column("v"), width))
            queries = batch.filter(pa.array(asks))
            for at in range(0, len(queries), query_rows):
                some = queries.slice(at, query_rows)
                if len(ids) > 1:  # the queries come behind all rows
                    ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
                q = _matrix(some.column("v"), width)
                largest = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(rows[0].astype(float)).max(initial=0)) * width
                kind = np.float64 if largest < 2**53 else np.int64 if largest < 2**62 else object
                if kind not in lists:
                    lists[kind] = Lists(ids[0], rows[0].astype(kind))
                out: list[tuple[int, int, int]] = []
                for own, query, floor in zip(some.column("vec_id").to_pylist(), q.astype(kind), some.column("floor").to_pylist(), strict=True):
                    best, scores = lists[kind].search(query, own, k, floor)
                    out += [(own, int(i), min(max(int(s), _LONG.min), _LONG.max)) for i, s in zip(best, scores, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"])

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best candidates (all, if fewer).

    Both tables have vec_id and ``v`` (see :func:`quantised`); shorter vectors count as filled up with
    zeros.  A query's own id is no candidate.  Rows of a repeated id are candidates of their own; a
    query id that stands twice is one query, with the best of both.  Empty tables give an empty one;
    columns but vec_id and ``v`` are not looked at.  Scores are exact; one beyond a long's range is
    given as the range's end.
    """
    spark = candidates.sparkSession
    counts = candidates.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).crossJoin(queries.agg(F.max(F.size("v")).alias("other"))).head()
    width = max(counts["width"] or 0, counts["other"] or 0)
    shards = max(1, -(-counts["n"] // shard_rows), min(-(-counts["n"] // 2048), spark.sparkContext.defaultParallelism))
    none = F.lit(None).cast("long")
    shard_of = lambda *c: F.pmod(F.xxhash64(*c), F.lit(shards)).cast("int")
    rows = candidates.select("vec_id", "v", none.alias("floor"), F.lit(False).alias("is_query"), shard_of("vec_id", "v").alias("shard"))
    asked = queries.dropDuplicates(["vec_id", "v"]).select("vec_id", "v", none.alias("floor"), F.lit(True).alias("is_query"), shard_of("vec_id").alias("shard"))

    def searched(asked: DataFrame) -> DataFrame:
        both = rows.unionByName(asked).repartitionById(shards, F.col("shard")).sortWithinPartitions("is_query")
        return both.mapInArrow(_searcher(k, width, query_rows), _OUT)

    found = searched(asked)
    if shards > 1:
        found = materialise(found, "home-shards")
        floors = found.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
        floored = asked.drop("floor").join(floors.select(F.col("query_id").alias("vec_id"), "floor"), "vec_id", "left")
        others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("shard"))
        found = found.unionByName(searched(floored.withColumn("shard", F.explode(others))))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
