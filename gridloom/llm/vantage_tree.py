"""Hard negatives by vantage-point trees over norm-augmented vectors.

With M at least the largest norm of a row, a row x gets one more component sqrt(M^2 - |x|^2) and an
anchor q gets 0.  Then |x' - q'|^2 = M^2 + |q|^2 - 2 q.x: the higher a score q.x, the nearer the row, and
a window of scores is an annulus of distances around the anchor.

Rows are dealt to regions by a small tree whose vantage points come from a bounded sample, and regions
to shards of bounded size, so that a region of any size has as many shards as it takes.  Each shard has
a tree of its own.  An anchor's own region is searched first; what it finds is a floor, and only regions
whose distances may beat the floor inside the annulus are searched after it.  In a tree, leaves come
nearest first; those wholly nearer than the annulus are passed over, and the search ends at the first
leaf that cannot hold anything better than what is there.  Trees only say where to look: scores are
integer products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import drop_since, mark, materialise

#: Rows of a shard at most (smaller tables have smaller ones, so that all tasks have work), of a leaf, and
#: anchors that a shard's task meets at most.
SHARD_ROWS, LEAF_ROWS, ANCHOR_ROWS = 16384, 256, 1 << 18
#: Regions, and rows of the sample that their vantage points come from, at most.
REGIONS, SAMPLE = 256, 4096
_FOUND = "anchor_id long, no long, vec_id long, score long"
_WINDOWS = "array<struct<no:long,low:long,high:long,floor:long>>"
_BATCH = 512
_LONG = np.iinfo(np.int64)


def labelled(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label and ``v``: floor(scale * x) of each component as double, as longs.

    Rows without id or label, and vectors that are null or hold a null or non-finite component, are left
    out.  Other columns are dropped; repeated rows stay.
    """
    x = F.col("embedding")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    rows = vectors.where(x.isNotNull() & ~odd & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


class Tree:
    """A balanced tree over points: each inner node has a vantage point, and its nearer and farther half have
    the least and greatest distance from it.  Leaves are slices of ``order``."""

    def __init__(self, points: np.ndarray, leaf: int) -> None:
        n = len(points)
        self.depth = max(0, int(np.ceil(np.log2(max(1, n / leaf)))))
        self.order = np.arange(n)
        self.vantage = np.zeros((2**self.depth - 1, points.shape[1]))
        self.split = np.zeros(len(self.vantage))
        self.near, self.far = np.full(2 ** (self.depth + 1) - 1, np.inf), np.zeros(2 ** (self.depth + 1) - 1)
        cuts = [np.array([0, n])]
        for level in range(self.depth):
            at = cuts[-1]
            middle = (at[:-1] + at[1:]) // 2
            for i, (a, m, b) in enumerate(zip(at[:-1], middle, at[1:], strict=True)):
                node = 2**level - 1 + i
                own = points[self.order[a:b]]
                # the point farthest from the slice's first: distances from an edge differ more than from the middle
                vantage = own[np.argmax(((own - own[0]) ** 2).sum(1))] if b > a else np.zeros(points.shape[1])
                distance = np.sqrt(((own - vantage) ** 2).sum(1))
                halves = np.argsort(distance, kind="stable")
                self.order[a:b] = self.order[a:b][halves]
                distance, self.vantage[node] = distance[halves], vantage
                for child, part in ((2 * node + 1, distance[: m - a]), (2 * node + 2, distance[m - a :])):
                    if len(part):
                        self.near[child], self.far[child] = part[0], part[-1]
                self.split[node] = (self.far[2 * node + 1] + self.near[2 * node + 2]) / 2 if b - a > 1 else 0.0
            cuts.append(np.sort(np.concatenate([at, middle])))
        self.cuts = cuts[-1]

    def _to_vantage(self, q: np.ndarray) -> np.ndarray:
        square = (q**2).sum(1)[:, None] + (self.vantage**2).sum(1)[None] - 2 * (q @ self.vantage.T)
        return np.sqrt(np.maximum(square, 0))

    def leaf_bounds(self, q: np.ndarray, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance that each leaf's points may have from each query; with ``whole``, that
        all points which :meth:`route` sends there may have."""
        d = self._to_vantage(q)
        least, most = np.zeros((len(q), 1)), np.full((len(q), 1), np.inf)
        for level in range(self.depth):
            nodes = np.arange(2**level - 1, 2 ** (level + 1) - 1)
            children = np.stack([2 * nodes + 1, 2 * nodes + 2], 1).ravel()
            near, far = self.near[children], self.far[children]
            if whole:
                split = self.split[nodes]
                near, far = np.stack([np.zeros_like(split), split], 1).ravel(), np.stack([split, np.full_like(split, np.inf)], 1).ravel()
            d2 = np.repeat(d[:, nodes], 2, axis=1)
            least = np.maximum(np.repeat(least, 2, axis=1), np.maximum(near - d2, d2 - far))
            most = np.minimum(np.repeat(most, 2, axis=1), d2 + far)
        return least, most

    def route(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point, by the radius between the halves."""
        d, node = self._to_vantage(points), np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (d[np.arange(len(points)), node] > self.split[node])
        return node - (2**self.depth - 1)


class Shard:
    """A shard's rows in the order of their tree's leaves."""

    def __init__(self, ids, labels, vectors, width: int, reach: float) -> None:
        rows = _matrix(vectors, width)
        self.largest = float(np.abs(rows.astype(float)).max(initial=0))
        self.square = reach * reach
        self.width = width
        self.tree = Tree(augmented(rows, self.square), LEAF_ROWS)
        order = self.tree.order
        self.ids, self.labels, self.rows = np.asarray(ids, np.int64)[order], np.asarray(labels, np.int64)[order], rows[order]
        self.exact: dict[type, np.ndarray] = {}

    def _rows_as(self, kind: type) -> np.ndarray:
        if kind not in self.exact:
            self.exact[kind] = self.rows.astype(kind)
        return self.exact[kind]

    def search(self, anchors: list[tuple], k: int) -> Iterator[tuple[int, int, int, int]]:
        """(anchor, no, vec_id, score) of the k best rows in each of the anchors' windows.

        An anchor is (id, label, vector, same, windows of (no, low, high, floor)): ``same`` asks for rows of
        its own label, else for those of others; the scores lie from low to high and not below the floor.
        """
        q = _matrix([a[2] for a in anchors], self.width)
        size = float(np.abs(q.astype(float)).max(initial=0)) * self.largest * self.width
        kind = np.float64 if size < 2**53 else object
        rows, exact = self._rows_as(kind), q.astype(kind)
        norms = (q.astype(float) ** 2).sum(1)
        least, most = self.tree.leaf_bounds(np.c_[q.astype(float), np.zeros(len(q))])
        give = 1e-6 * np.sqrt(self.square + norms)[:, None] + 1e-6  # distances are floats
        best = (self.square + norms[:, None] - np.maximum(least - give, 0) ** 2) / 2 + 0.5
        worst = (self.square + norms[:, None] - (most + give) ** 2) / 2 - 0.5
        for i, (own, label, _, same, windows) in enumerate(anchors):
            low = [max(x for x in (w[1], w[3], _LONG.min) if x is not None) for w in windows]
            high = [_LONG.max if w[2] is None else w[2] for w in windows]
            need, top = np.array(low, kind), np.array(high, kind)
            found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, kind))] * len(windows)
            for leaf in np.argsort(-best[i], kind="stable"):  # nearest first
                if best[i, leaf] < need.min():
                    break
                if worst[i, leaf] > top.max():  # nearer than the annulus
                    continue
                a, b = self.tree.cuts[leaf], self.tree.cuts[leaf + 1]
                scores = rows[a:b] @ exact[i]
                fits = (self.ids[a:b] != own) & ((self.labels[a:b] == label) == same)
                inside = (scores >= need[:, None]) & (scores <= top[:, None]) & fits
                for w in np.flatnonzero(inside.any(1)):
                    ids = np.concatenate([found[w][0], self.ids[a:b][inside[w]]])
                    values = np.concatenate([found[w][1], scores[inside[w]]])
                    first = np.lexsort((ids, -values))[:k]
                    found[w] = ids[first], values[first]
                    if len(first) == k:
                        need[w] = max(need[w], values[first[-1]])
            for (no, *_), (ids, values) in zip(windows, found, strict=True):
                yield from ((own, no, int(x), min(max(int(s), _LONG.min), _LONG.max)) for x, s in zip(ids, values, strict=True))


def augmented(rows: np.ndarray, square: float) -> np.ndarray:
    """Rows with the component that gives all of them the norm whose square is ``square``."""
    rows = rows.astype(float)
    return np.c_[rows, np.sqrt(np.maximum(square - (rows**2).sum(1), 0))]


def _searcher(width: int, reach: float, k: int):
    """Over a partition sorted by shard, block and kind: a shard's rows first, then its anchors in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard, held, waiting = None, None, ([], [], []), []

        def answers() -> Iterator[pa.RecordBatch]:
            nonlocal shard
            if waiting and shard is None:
                shard = Shard(*held, width, reach)
            found = list(shard.search(waiting, k)) if waiting and len(shard.ids) else []
            waiting.clear()
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["anchor_id", "no", "vec_id", "score"])

        for batch in batches:
            for place, block, is_anchor, vec_id, label, v, same, windows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (place, block) != at:
                    yield from answers()
                    at, shard, held = (place, block), None, ([], [], [])
                if is_anchor:
                    waiting.append((vec_id, label, v, same, [tuple(w.values()) for w in windows]))
                    if len(waiting) >= _BATCH:
                        yield from answers()
                else:
                    for column, value in zip(held, (vec_id, label, v), strict=True):
                        column.append(value)
        yield from answers()

    return run


class Index:
    """Rows (vec_id, label, v) dealt to regions and shards, as a written table."""

    def __init__(self, rows: DataFrame, shard_rows: int = SHARD_ROWS, anchor_rows: int = ANCHOR_ROWS) -> None:
        spark = rows.sparkSession
        self.spark, self.anchor_rows = spark, anchor_rows
        square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("square"), F.max(F.size("v")).alias("width")).head()
        self.n, self.width = facts["n"], facts["width"] or 0
        self.reach = float(np.sqrt(facts["square"] or 0.0)) * (1 + 1e-9) + 1.0
        size = max(1, min(shard_rows, max(2048, -(-self.n // max(1, spark.sparkContext.defaultParallelism)))))
        regions = max(1, min(REGIONS, -(-self.n // size)))
        share = min(1.0, 2 * SAMPLE / max(1, self.n))
        drawn = rows.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(2**31)) < int(share * 2**31)).limit(SAMPLE).select("v").collect()
        self.tree = Tree(augmented(_matrix([r["v"] for r in drawn], self.width), self.reach**2), max(1.0, len(drawn) / regions))
        placed = materialise(rows.withColumns({"region": self._region(F.col("v")), "row": F.monotonically_increasing_id()}), "regions")
        counts = {r["region"]: r["count"] for r in placed.groupBy("region").count().collect()}
        self.shards, first = {}, 0
        for region in sorted(counts):
            self.shards[region] = (first, -(-counts[region] // size))
            first += self.shards[region][1]
        self.n_shards = first
        self.rows = placed.withColumn("shard", self._of_region("region", 0) + F.pmod("row", self._of_region("region", 1)).cast("int"))

    def _of_region(self, region: str, what: int) -> Column:
        return F.element_at(F.array(*[F.lit(int(self.shards.get(r, (0, 1))[what])) for r in range(2**self.tree.depth)]), F.col(region) + 1)

    def _region(self, v: Column) -> Column:
        tree, width, square = self.tree, self.width, self.reach**2

        @F.pandas_udf("int")
        def region(v: pd.Series) -> pd.Series:
            return pd.Series(tree.route(augmented(_matrix(v, width), square)))

        return region(v)

    def _regions_to_search(self, v: Column, windows: Column) -> Column:
        """Regions that an annulus, as far as the floor, may meet; an anchor's own is left out."""
        tree, width, square = self.tree, self.width, self.reach**2

        @F.pandas_udf("array<int>")
        def regions(v: pd.Series, low: pd.Series, high: pd.Series) -> pd.Series:
            q = _matrix(v, width)
            least, most = tree.leaf_bounds(np.c_[q.astype(float), np.zeros(len(q))], whole=True)
            norms = (q.astype(float) ** 2).sum(1)[:, None]
            give = 1e-6 * np.sqrt(square + norms) + 1e-6
            best = (square + norms - np.maximum(least - give, 0) ** 2) / 2 + 0.5
            worst = (square + norms - (most + give) ** 2) / 2 - 0.5
            home = tree.route(augmented(q, square))
            out = []
            for i, (lows, highs) in enumerate(zip(low, high, strict=True)):
                meet = np.zeros(best.shape[1], bool)
                for a, b in zip(lows, highs, strict=True):
                    meet |= (best[i] >= float(a)) & (worst[i] <= float(b))
                meet[home[i]] = False
                out.append(np.flatnonzero(meet).tolist())
            return pd.Series(out, dtype=object)

        lowest = F.transform(windows, lambda w: F.greatest(F.coalesce(w["low"], F.lit(_LONG.min)), F.coalesce(w["floor"], F.lit(_LONG.min))))
        highest = F.transform(windows, lambda w: F.coalesce(w["high"], F.lit(_LONG.max)))
        return regions(v, lowest, highest)

    def _searched(self, anchors: DataFrame, k: int, blocks: int) -> DataFrame:
        """Found rows of anchors with ``regions``."""
        to = anchors.withColumn("region", F.explode("regions"))
        first, number = self._of_region("region", 0), self._of_region("region", 1)
        held = F.lit(sorted(self.shards))
        to = to.where(F.array_contains(held, F.col("region"))).withColumn("shard", F.explode(F.sequence(first, first + number - 1)))
        block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
        to = to.select("shard", block.alias("block"), F.lit(True).alias("is_anchor"), "vec_id", "label", "v", "same", "windows")
        rows = self.rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))) if blocks > 1 else F.lit(0))
        rows = rows.select("shard", "block", F.lit(False).alias("is_anchor"), "vec_id", "label", "v", F.lit(None).cast("boolean").alias("same"), F.lit(None).cast(_WINDOWS).alias("windows"))
        both = rows.unionByName(to).repartitionById(self.n_shards * blocks, F.col("shard") * blocks + F.col("block"))
        return both.sortWithinPartitions("shard", "block", "is_anchor").mapInArrow(_searcher(self.width, self.reach, k), _FOUND)

    def nearest(self, anchors: DataFrame, k: int) -> DataFrame:
        """anchor_id, no, rank, vec_id, score: the k best rows (all, if fewer) in each window of each anchor.

        Anchors have vec_id, label, v, same and windows (see :meth:`Shard.search`; null bounds are none).
        """
        if not self.n:
            return self.spark.createDataFrame([], "anchor_id long, no long, rank int, vec_id long, score long")
        blocks = max(1, -(-anchors.count() // self.anchor_rows))
        best = Window.partitionBy("anchor_id", "no").orderBy(F.desc("score"), "vec_id")
        ranked = lambda found: found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        home = materialise(ranked(self._searched(anchors.withColumn("regions", F.array(self._region(F.col("v")))), k, blocks)), "home")
        if len(self.shards) > 1:
            floors = home.where(F.col("rank") == k).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("no", "score"))).alias("floors"))
            floored = anchors.join(floors.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left")
            windows = F.transform("windows", lambda w: F.struct(w["no"].alias("no"), w["low"].alias("low"), w["high"].alias("high"), F.try_element_at("floors", w["no"]).alias("floor")))
            floored = floored.withColumn("windows", windows).drop("floors")
            floored = floored.withColumn("regions", self._regions_to_search(F.col("v"), F.col("windows")))
            home = ranked(home.drop("rank").unionByName(self._searched(floored, k, blocks)))
        return home.select("anchor_id", "no", "rank", "vec_id", "score")


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, k: int = 3, low: int = 50, high: int = 95, shard_rows: int = SHARD_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Both tables have vec_id, label and ``v`` (see :func:`labelled`).  An anchor's positives are its best
    rows of the same label; for each, the result has the k best rows (all, if fewer) of other labels whose
    score is from low to high percent of the positive's, ties to the smaller id.  A positive of negative
    score has no such window.  Rows of the anchor's own id are neither.  Rows of a repeated id are rows of
    their own; of anchors with one id only the least label and vector counts.  Shorter vectors count as
    filled up with zeros.  Empty tables give an empty one; other columns are not looked at.  Scores beyond a
    long's range are given as the range's end.
    """
    began = mark()
    index = Index(rows.select("vec_id", "label", "v"), shard_rows, anchor_rows)
    one = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a")).select("vec_id", "a.label", "a.v")
    one = materialise(one, "anchors")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("no"), *[F.lit(None).cast("long").alias(c) for c in ("low", "high", "floor")]))
    near = materialise(index.nearest(one.withColumns({"same": F.lit(True), "windows": whole}), positives), "positives")
    near = near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).where("positive_score >= 0")
    share = lambda c, p, up: F.expr(f"{c} div 100 * {p} + ({c} % 100 * {p} + {99 if up else 0}) div 100")
    window = F.struct(F.col("positive_score").alias("no"), share("positive_score", low, True).alias("low"), share("positive_score", high, False).alias("high"), F.lit(None).cast("long").alias("floor"))
    windows = near.groupBy("anchor_id").agg(F.collect_set(window).alias("windows")).withColumnRenamed("anchor_id", "vec_id")
    asked = materialise(one.join(windows, "vec_id").withColumn("same", F.lit(False)), "windows")
    found = materialise(index.nearest(asked, k).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score", "no": "positive_score"}), "negatives")
    out = near.join(found, ["anchor_id", "positive_score"])
    drop_since(rows.sparkSession, began, out)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
