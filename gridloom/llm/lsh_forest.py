"""MinHash near-duplicates with an LSH forest.

Documents of equal shingle sets are one class, and one member stands for it.  A class has a signature
of ``HASHES`` minima.  Each of ``TREES`` trees reads the signature from another place, and all classes
are sorted by what it reads: a region of a tree is a run of classes with a common prefix of at least
``SHORTEST`` minima.  A region of more than ``CROWD`` classes is looked at one minimum deeper, and so
on, so dense regions are explored deeper than sparse ones.  Candidates are neighbours in the order, all
pairs of a region of at most ``CROWD`` classes, and the first class of a deepest region with each other
one of it (instead of neighbours); so there are a few candidates for each class and tree, however large a region is.

Candidates are confirmed on full shingle sets, in rounds that leave out what is already linked:
the best candidate of each class; every other between classes not yet linked together; and the rest
of every group.  A group is made of the components that a crowded deepest region or a promising
candidate joins; each class of it outside its largest component is compared with all of it, in tiles of
fixed size (among thousands of near copies of one text the few that a class links with are not always
among its neighbours).  So two classes with ``DEEPEST`` minima of a tree in common are compared, unless
they are linked already, however crowded the region is.  The sorts are range-partitioned, so a group of
copies is split over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .storage import drop_since, mark, materialise, small_batches, trim_memory
from .words import mix, shingle_hashes, word_hashes

HASHES, TREES, SHORTEST, DEEPEST, CROWD = 128, 32, 4, 8, 4
#: Signature estimates this much below the threshold rule a pair out (5 standard deviations).
SLACK = 0.18
#: Classes of a group that are compared with so many others of it at a time.
TILE = 256

_ODD = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct ``width``-word shingles; of all words as one if there are fewer."""
    return np.unique(shingle_hashes(word_hashes(text), width))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Low 16 bits of ``HASHES`` minima."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 256):
        z = shingles[at : at + 256] * _ODD[:, None]
        z ^= z >> np.uint64(31)
        np.minimum(least, z.min(1), out=least)
    return (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)


def signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, key (16 bytes, equal for equal sets) and sig of each whole text."""

    @F.pandas_udf(T.StructType([T.StructField("n", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("sig", T.BinaryType())]))
    def of(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            s = shingle_set(text, width)
            sums = np.array([s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)], np.uint64)
            out.append((len(s), sums.tobytes() if len(s) else None, signature(s).astype(">u2").tobytes() if len(s) else None))
        return pd.DataFrame(out, columns=["n", "key", "sig"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), of("text").alias("s")).select("doc_id", F.col("s.n").alias("n_shingles"), "s.key", "s.sig")


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidate pairs of sorted (tree, label, node) rows; the ends of each partition come out as rows
    with a null ``b`` for stitching."""
    carried = None
    for batch in batches:
        if not len(batch):
            continue
        tree, node = batch["tree"].to_numpy(np.int64), batch["node"].to_numpy(np.int64)
        label = np.frombuffer(b"".join(batch["label"]), ">u2").reshape(len(batch), DEEPEST)
        if carried is None:
            yield _ends(tree, node, batch["label"], 0)
        else:  # the row before goes in front
            tree, node = np.r_[carried[0], tree], np.r_[carried[1], node]
            label = np.vstack([carried[2], label])
        carried = tree[-1], node[-1], label[-1]
        last = batch["label"].iloc[-1]
        for (a, b), crowded in ((_candidates(tree, node, label), False), (_crowded(tree, node, label), True)):
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "tree": 0, "label": None, "crowded": crowded})
    if carried is not None:
        yield pd.DataFrame({"a": [carried[1]], "b": pd.array([None], "Int64"), "tree": [carried[0]], "label": [last], "crowded": False})
    trim_memory()


def _ends(tree: np.ndarray, node: np.ndarray, label: pd.Series, i: int) -> pd.DataFrame:
    return pd.DataFrame({"a": [node[i]], "b": pd.array([None], "Int64"), "tree": [tree[i]], "label": [label.iloc[i]], "crowded": False})


def _crowded(tree: np.ndarray, node: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first class with each other one of the deepest regions that are crowded or may go on in the
    rows before or after."""
    n = len(node)
    rows = np.arange(n)
    goes_on = np.r_[False, (label[1:] == label[:-1]).all(1) & (tree[1:] == tree[:-1])]
    head = np.maximum.accumulate(np.where(goes_on, 0, rows))
    size = np.bincount(head, minlength=n)[head]
    i = rows[goes_on & ((size > CROWD) | (head == 0) | (head == head[-1])) & (node != node[head])]
    return node[head[i]], node[i]


def _candidates(tree: np.ndarray, node: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(node)
    common = np.zeros(n, np.int64)  # length of the prefix shared with the row before
    same = (label[1:] == label[:-1]) & (tree[1:] == tree[:-1])[:, None]
    common[1:] = np.cumprod(same, axis=1).sum(1)
    rows = np.arange(n)
    pairs = []
    beside = common >= SHORTEST
    settled = np.zeros(n, bool)
    above = None
    for depth in range(SHORTEST, DEEPEST + 1):
        head = np.maximum.accumulate(np.where(common < depth, rows, 0))
        size = np.bincount(head, minlength=n)[head]
        here = ~settled & ((size <= CROWD) | (depth == DEEPEST))
        star = here & (head != rows)
        beside &= ~(star & (size > CROWD))  # both neighbours have the same first class
        pairs.append((head[star], rows[star]))
        for gap in range(2, CROWD):  # all pairs of a small region; those one apart are in already
            i = rows[gap:][here[gap:] & (size[gap:] <= CROWD) & (head[gap:] == head[:-gap])] if n > gap else rows[:0]
            pairs.append((i - gap, i))
        if above is not None:
            up = ~settled & (head == rows) & (above != rows)
            pairs.append((above[up], rows[up]))
        above = head
        settled |= here
    pairs.append((rows[beside] - 1, rows[beside]))
    i, j = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    keep = node[i] != node[j]
    return node[i[keep]], node[j[keep]]


def candidates(classes: DataFrame) -> DataFrame:
    """Candidate pairs a < b of a table (node, sig), in how many ways (``n``) the forest names them, and
    whether they share a ``crowded`` deepest region; these pairs connect all classes of each such region."""
    spark = classes.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    step = HASHES // TREES
    wrapped = F.concat("sig", "sig")
    labels = F.array(*[F.substring(wrapped, 1 + 2 * step * t, 2 * DEEPEST) for t in range(TREES)])
    rows = classes.select("node", F.posexplode(labels).alias("tree", "label"))
    ordered = rows.repartitionByRange(parts, "tree", "label", "node").sortWithinPartitions("tree", "label", "node")
    found = ordered.mapInPandas(_walk, "a long, b long, tree int, label binary, crowded boolean")
    ways = F.sum(F.when(F.col("crowded"), 0).otherwise(1)).alias("n"), F.max("crowded").alias("crowded")
    found = materialise(found.groupBy("a", "b", "tree", "label").agg(*ways), "forest")
    ends = sorted(((r["tree"], bytes(r["label"]), r["a"]) for r in found.where(F.col("b").isNull()).collect()))  # two a partition
    stitched = [
        (min(x[2], y[2]), max(x[2], y[2]), 1, x[1] == y[1])
        for x, y in zip(ends, ends[1:])
        if x[0] == y[0] and x[1][: 2 * SHORTEST] == y[1][: 2 * SHORTEST] and x[2] != y[2]
    ]
    pairs = found.where(F.col("b").isNotNull()).select("a", "b", "n", "crowded")
    if stitched:
        pairs = pairs.unionByName(spark.createDataFrame(stitched, "a long, b long, n long, crowded boolean"))
        pairs = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("crowded").alias("crowded"))
    return pairs


def _both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Pairs with the column's value of either end."""
    side = lambda end: table.select(F.col("node").alias(end), F.col(column).alias(f"{column}_{end}"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


@F.pandas_udf(T.DoubleType())
def _estimate(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    rows = lambda s: np.frombuffer(b"".join(s), np.uint16).reshape(len(s), HASHES)
    return pd.Series((rows(a) == rows(b)).mean(1))


def _confirmer(num: int, den: int):
    @F.pandas_udf(T.StructType([T.StructField("linked", T.BooleanType()), T.StructField("likeness", T.DoubleType())]))
    def confirm(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            either = len(x) + len(y) - both
            out.append((den * both >= num * either, both / either))
        return pd.DataFrame(out, columns=["linked", "likeness"])

    return confirm


def _tile(num: int, den: int):
    """Links between the components of a block of classes and those of one tile of their group, by an index from
    shingle to class: one for each two components, however many of their classes are alike."""

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out: set[tuple[int, int]] = set()
        if len(asked) and len(held):
            sets = [np.frombuffer(s, np.uint64) for s in held["set"]]
            theirs, lengths = held["component"].to_numpy(np.int64), np.array([len(s) for s in sets])
            owner = np.repeat(np.arange(len(sets)), lengths)
            flat = np.concatenate(sets)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            for own, packed in zip(asked["component"].astype("int64"), asked["set"], strict=True):
                s = np.frombuffer(packed, np.uint64)
                first, last = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
                hits = np.concatenate([owner[i:j] for i, j in zip(first, last, strict=True)])
                both = np.bincount(hits, minlength=len(sets))
                linked = (den * both >= num * (lengths + len(s) - both)) & (theirs != own)
                out.update((min(own, c), max(own, c)) for c in set(theirs[linked].tolist()))
        return pd.DataFrame(sorted(out), columns=["a", "b"]).astype("int64")

    return search


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, slack: float = SLACK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs``.

    Linked are texts whose sets of distinct ``width``-word shingles have den * intersection >= num *
    union; ``component_id`` is the smallest doc_id that links lead to, and ``kept`` marks the document
    that has it.  Null or white texts have no shingles and no links, nor have rows without doc_id
    (component null, kept); rows of one doc_id are one document; extra columns are not looked at; an
    empty table gives an empty one.

    Of candidates between components only those are compared whose signatures agree to within ``slack`` of the
    wanted likeness; ``slack=1.0`` compares all.
    """
    began = mark()
    table = materialise(signed(docs, width), "signed")
    known = table.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = materialise(known.groupBy("key").agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n")), "classes")
    pairs = materialise(candidates(classes.select("node", "sig")), "pairs")

    # shingle sets of the classes that have candidates
    ends = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()

    @F.pandas_udf(T.BinaryType())
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shingle_set(t, width).tobytes())

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    # a merge join at every size: what is broadcast must not depend on how many classes have candidates
    sets = texts.join(ends.hint("merge"), "doc_id", "left_semi").select(F.col("doc_id").alias("node"), packed("text").alias("set"))
    sets = materialise(sets.where(F.octet_length("set") > 0), "sets")
    sigs = classes.select("node", "sig")
    confirm = _confirmer(num, den)

    def tested(pairs: DataFrame) -> DataFrame:
        return materialise(_both(pairs, sets, "set").select("a", "b", confirm("set_a", "set_b").alias("c")).select("a", "b", "c.linked", "c.likeness"), "tested")

    def promising(pairs: DataFrame, *more: str) -> DataFrame:
        return _both(pairs, sigs, "sig").withColumn("e", _estimate("sig_a", "sig_b")).where(F.col("e") >= num / den - slack).select("a", "b", *more).distinct()

    def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs with the components of their ends, where those differ."""
        side = lambda end: labels.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
        joined = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
        joined = joined.withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")})
        return joined.where("ca <> cb")

    # 1. the best candidate of each class
    either = pairs.select("a", "b", "n", F.explode(F.array("a", "b")).alias("node"))
    best = either.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("n", -(F.col("b") - F.col("a")))).alias("p")).select("p.a", "p.b").distinct()
    checked = tested(best)
    links = checked.where("linked").select("a", "b")
    labels = connected_components(links)
    # 2. all others between components
    loose = materialise(apart(pairs.select("a", "b", "crowded"), labels).select("a", "b", "crowded"), "loose")  # what is linked stays so
    hopeful = materialise(promising(loose), "hopeful")
    more = tested(hopeful.join(checked.select("a", "b"), ["a", "b"], "left_anti"))
    links = links.unionByName(more.where("linked").select("a", "b"))
    labels = connected_components(links)
    # 3. the rest of every group: components that a crowded region or a promising candidate joins
    joined = apart(loose.where("crowded").select("a", "b").unionByName(hopeful), labels)
    joined = joined.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
    groups = connected_components(joined).select(F.col("node").alias("component"), F.col("component").alias("group"))
    inside = labels.unionByName(groups.join(labels, "component", "left_anti").select(F.col("component").alias("node"), "component"))
    inside = materialise(inside.join(groups, "component"), "groups")
    sizes = inside.groupBy("group", "component").agg(F.count(F.lit(1)).alias("size"))
    cuts = sizes.groupBy("group").agg(F.sum("size").alias("all"), F.max_by("component", F.struct("size", "component")).alias("largest"), F.max("size").alias("most"))
    cuts = cuts.where(F.col("all") > 2)  # the only pair of two classes was named, and compared above
    cuts = cuts.select("group", "largest", F.ceil((F.col("all") - F.col("most")) / TILE).cast("int").alias("blocks"), F.ceil(F.col("all") / TILE).cast("int").alias("tiles"))
    # its classes outside the largest component are cut into blocks, and all into tiles; block meets tile
    held = materialise(inside.join(cuts, "group").join(sets, "node"), "rest")
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = held.where(F.col("component") != F.col("largest")).select(*[F.col(c).alias(c) for c in ("node", "group", "component", "set")], part("blocks").alias("block"), each("tiles").alias("tile"))
    held = held.select("node", "group", "component", "set", part("tiles").alias("tile"), each("blocks").alias("block"))
    keys = "group", "tile", "block"
    late = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(_tile(num, den), "a long, b long")
    links = links.unionByName(materialise(late.distinct(), "late"))
    labels = connected_components(links)

    drop_since(docs.sparkSession, began, table, classes, labels)

    members = known.select("doc_id", "n_shingles", "key").join(classes.select("key", "node"), "key").join(labels, "node", "left")
    # rows of one doc_id are one document, even if their texts are in different classes
    members = members.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    others = table.where(~((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = members.unionByName(others)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
