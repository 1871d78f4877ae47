"""Mixing sources to target weights by balanced (cube) sampling.

Every document of a source has the same rate of copies: its whole part is taken for sure, its
fraction p is an inclusion probability.  The flight phase keeps, for each source, both balancing
totals (documents, and words) while it moves the probabilities along the null space of the two
constraints until they are 0 or 1: three undecided documents at a time have such a direction, and
each step decides at least one of them.  Documents fly in chunks of fixed size; the two that a chunk
cannot decide fly again with those of other chunks, level by level, until one chunk a source is left.
A dozen of its documents stay out of the flight; they and the last two undecided are landed together
on the whole numbers nearest to the balance.

Only ids, sizes and sources are shuffled, never texts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop_since, mark, materialise
from .words import WORD

CHUNK = 2048
#: Documents of all lengths that the last chunk of a source leaves to the landing phase.
LANDING = 12
_EDGE = 1e-9
_SCHEMA = "doc_id long, size long, source string, row long, number long, source_size long, target double, base long, p double"


def sizes(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, source, the number of words of each whole text (null: 0), and ``row``, a number of its own for each row."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
    )


def numbered(table: DataFrame, *order) -> DataFrame:
    """Add ``number``: 0, 1, ... in the given total order, by a range sort and one count a partition."""
    parts = materialise(table.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = {r["part"]: r["n"] for r in parts.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        starts.append(total)
        total += counts.get(p, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), (part + 1).cast("int")) if starts else F.lit(0).cast("long")
    return parts.withColumn("number", start + row).drop("_at")


def source_targets(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, n_docs and target for each source.

    Weights repeat over the sources by code point, null last.  ``share`` of all words is dealt by
    weight; a target stops at ``most`` times its source's words, and what is over is dealt again
    among the others.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = numbered(per_source, F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    ranked = materialise(ranked.withColumn("weight", weight), "sources")
    total = ranked.agg(F.sum("source_size").alias("n")).head()["n"] or 0
    level = 0.0
    capped = F.lit(False)
    while total:
        row = ranked.agg(
            F.sum(F.when(capped, F.col("source_size"))).alias("full"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
        ).head()
        if not row["weight"]:
            break
        rising = (share * total - most * (row["full"] or 0)) / row["weight"]
        if rising <= level:
            break
        level = rising
        capped = F.col("weight") * level > most * F.col("source_size")
    target = F.least(F.col("weight") * level, most * F.col("source_size")).cast("double")
    return ranked.select("source", "source_size", "n_docs", target.alias("target"))


def fly(p: np.ndarray, size: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Flight phase over one chunk, in its order: the new p, all but two of them 0 or 1 at most.

    Sums of p and of p * size stay as they were.  ``draws`` are uniform numbers, one a document.
    """
    p = p.astype(float).copy()
    x = size.astype(float).tolist()
    waiting = [i for i in range(len(p)) if _EDGE < p[i] < 1 - _EDGE]
    values, draws = p.tolist(), draws.tolist()
    trio: list[int] = []
    for at, i in enumerate(waiting):
        trio.append(i)
        if len(trio) < 3:
            continue
        a, b, c = trio
        u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = down = math.inf
        for j, d in zip(trio, u, strict=True):
            if d > 0:
                up, down = min(up, (1 - values[j]) / d), min(down, values[j] / d)
            elif d < 0:
                up, down = min(up, values[j] / -d), min(down, (1 - values[j]) / -d)
        step = up if draws[waiting[at]] * (up + down) < down else -down
        for j, d in zip(trio, u, strict=True):
            moved = values[j] + step * d
            values[j] = 0.0 if moved < _EDGE else 1.0 if moved > 1 - _EDGE else moved
        trio = [j for j in trio if 0 < values[j] < 1]
    # with fewer than three left, two of equal size still have a direction
    if len(trio) == 2 and x[trio[0]] == x[trio[1]]:
        a, b = trio
        up, down = min(1 - values[a], values[b]), min(values[a], 1 - values[b])
        step = up if draws[a] * (up + down) < down else -down
        for j, d in ((a, step), (b, -step)):
            moved = values[j] + d
            values[j] = 0.0 if moved < _EDGE else 1.0 if moved > 1 - _EDGE else moved
    return np.array(values)


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Landing phase for the few undecided: the whole numbers that keep the words' total best, then the documents'."""
    p = p.copy()
    left = np.flatnonzero((p > 0) & (p < 1))
    if len(left):
        options = np.array(np.meshgrid(*[[0.0, 1.0]] * len(left))).reshape(len(left), -1).T
        words = np.abs((options - p[left]) @ size[left].astype(float))
        documents = np.abs((options - p[left]).sum(1))
        p[left] = options[np.lexsort((documents, words))[0]]
    return p


def _level(landing: bool):
    def one_chunk(chunk: pd.DataFrame) -> pd.DataFrame:
        # long documents first: the undecided rest, which the landing rounds, is mostly short ones
        chunk = chunk.sort_values(["size", "order"], ascending=[False, True], kind="stable", ignore_index=True)
        draws = np.random.default_rng(chunk["order"].to_numpy().view(np.uint64)[:1]).random(len(chunk))
        p, size = chunk["p"].to_numpy(float), chunk["size"].to_numpy()
        free = np.flatnonzero((p > _EDGE) & (p < 1 - _EDGE))
        grounded = free[np.unique(np.linspace(0, len(free) - 1, LANDING).astype(int))] if landing and len(free) else free[:0]
        flying = np.setdiff1d(np.arange(len(p)), grounded)
        p = p.copy()
        p[flying] = fly(p[flying], size[flying], draws[flying])
        if landing:
            p = land(p, size)
        return chunk.assign(p=p)[[c.split()[0] for c in _SCHEMA.split(", ")]]

    return one_chunk


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, chunk: int = CHUNK, row: str | None = None) -> DataFrame:
    """doc_id, size, source, source_size, target, taken (words) and copies of every document, and ``row`` if it is named.

    ``taken`` is the size times the copies that the mix takes, at most ``most`` times.  A null text
    has size 0 and takes nothing; a null source is a source of its own; repeated rows are documents
    of their own; extra columns are not looked at; an empty table gives an empty one.  The same
    documents give the same mix, however they are partitioned: chunks are dealt by a document's number
    in the order of source, id and size, where only alike documents can change places.  ``row`` names a
    column of unique longs to tell rows apart in the result (see :func:`repeat`).
    """
    began = mark()
    sized = materialise(sizes(docs, row), "sizes")
    targets = materialise(source_targets(sized, weights, share, most), "targets")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    placed = numbered(sized, F.asc_nulls_last("source"), F.asc_nulls_last("doc_id"), "size", "row")
    rows = placed.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source", "row", "number", "source_size", "target", "n_docs", F.floor(rate).alias("base"), (rate - F.floor(rate)).alias("p")
    )
    most_docs = targets.agg(F.max("n_docs").alias("n")).head()["n"] or 0
    flights: list[DataFrame] = []
    level = 0
    while True:
        chunks = F.ceil(F.col("n_docs") / chunk)
        order = F.xxhash64("number", F.lit(level))
        keyed = rows.withColumn("order", order).withColumn("chunk", F.pmod("order", chunks))
        last = most_docs <= chunk
        flown = materialise(keyed.groupBy("source", "chunk").applyInPandas(_level(last), _SCHEMA), f"flight-{level}")
        undecided = (F.col("p") > 0) & (F.col("p") < 1)
        flights.append(flown)
        if last:
            break
        rest = flown.where(undecided)
        per_source = rest.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs")).withColumnRenamed("source", "_source")
        most_docs = per_source.agg(F.max("n_docs").alias("n")).head()["n"] or 0
        rows = rest.join(per_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        level += 1
    drop_since(docs.sparkSession, began, *flights)
    done = reduce(DataFrame.unionByName, [flown.where(~undecided) for flown in flights])
    copies = F.col("base") + F.col("p").cast("long")
    return done.select("doc_id", "size", "source", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"), *(["row"] if row else []))


def repeat(docs: DataFrame, mixed: DataFrame, row: str) -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed`` takes it; both know a row by its number in ``row``.

    Rows that ``mixed`` does not know or takes 0 times are left out, so an empty table on either side gives an
    empty one; equal rows with numbers of their own are rows of their own; ``row`` is dropped, other columns stay.
    """
    taken = mixed.where("copies > 0").select(F.col("row").alias("_row"), F.col("copies").alias("_copies"))
    joined = docs.join(taken, F.col(row) == F.col("_row"))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[c for c in docs.columns if c != row])
