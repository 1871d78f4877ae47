"""URL filter: host and path rules first, then a tree of path templates per host.

Level by level, path segments under a node (a host and the template so far) become children.  A
segment that looks like an identifier, or one of many rare siblings, becomes a wildcard; of the other
children, those whose labelled block rate does not differ significantly from that of all siblings are
merged into the wildcard too.  Labels are the rules' verdicts.  A template is rejected when its block
rate, smoothed towards its host's and the whole table's, is at least ``reject``.

All counts are aggregated before they are shuffled; nodes are joined back on (host, template,
segment), so a host with a third of all pages is many keys below its first levels.  Paths of any depth
are read to their end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import drop_since, mark, materialise

#: (verdict, rule): a host and a path prefix each.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Segments of digits, long hex runs, dates and the like, with or without an ending.
_IDENTIFIER = r"^(?:[0-9][0-9._-]*|[0-9a-f-]{16,}|[^/]*[0-9]{4,}[^/]*)(?:\.[A-Za-z0-9]{1,5})?$"


def host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both empty without '://' or url."""
    u = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.regexp_extract(u, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.translate(host, _UPPER, _LOWER)).withColumn("path", path)


def matching_rule(rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict; null without one."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        fit = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit("/" + path))
        fits.append((fit, rule, verdict))
    pick = lambda k: F.coalesce(*[F.when(f[0], F.lit(f[k])) for f in fits]) if fits else F.lit(None).cast("string")
    return pick(1), pick(2)


def templates(urls: DataFrame, siblings: int = 16, rare: float = 4.0, z: float = 2.0) -> DataFrame:
    """host, path, template and counts for each distinct (host, path) of ``urls`` (host, path, verdict).

    An only child is never told apart from its siblings, so it is a wildcard: below a node with one child
    all paths go on together, in one round, to where they part, whatever paths end on the way, and a path
    that goes on alone goes to its end.  So there are as many rounds as places where paths part, one behind
    the other, and chains between them.  What a round joins are plain tables, so that Spark can split a host
    or segment with many paths.
    """
    counted = urls.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("verdict") == "block").cast("long")).alias("blocked"),
        F.count("verdict").alias("labelled"),
    )
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = materialise(
        counted.withColumn("rest", segments).withColumn("blocked", F.coalesce("blocked", F.lit(0))).withColumn("template", F.lit("")),
        "urls-0",
    )
    done = None
    while True:
        finished = rows.where(F.size("rest") == 0)
        done = finished if done is None else done.unionByName(finished)
        deeper = rows.where(F.size("rest") > 0).withColumn("segment", F.element_at("rest", 1))
        sums = [F.sum(c).alias(c) for c in ("n", "blocked", "labelled")]
        child = materialise(deeper.groupBy("host", "template", "segment").agg(*sums, F.count(F.lit(1)).alias("paths")), "children")
        node = child.groupBy("host", "template").agg(F.count(F.lit(1)).alias("_children"), *[F.sum(c).alias(f"_{c}") for c in ("n", "blocked", "labelled")])
        node = materialise(node, "nodes")
        if node.isEmpty():
            break
        rate, pooled = F.try_divide("blocked", "labelled"), F.try_divide("_blocked", "_labelled")
        deviation = F.sqrt(pooled * (1 - pooled) / F.col("labelled"))
        differs = F.coalesce((F.col("labelled") > 0) & (F.abs(rate - pooled) > z * deviation), F.lit(False))
        crowded = (F.col("_children") > siblings) & (F.col("n") < rare) & (F.col("_n") < rare * F.col("_children"))
        literal = ~F.col("segment").rlike(_IDENTIFIER) & ~crowded & differs
        name = F.when(literal, F.col("segment")).otherwise(F.lit("*"))
        apart = node.where("_children > 1")
        named = child.join(apart, ["host", "template"]).select("host", "template", "segment", name.alias("name"), (F.col("paths") == 1).alias("alone"))
        named = materialise(named, "named")
        beyond = F.when(F.col("alone"), F.size("rest") - 1).otherwise(0)
        grown = F.concat("template", F.lit("/"), "name", F.repeat(F.lit("/*"), beyond))
        moved = deeper.join(named, ["host", "template", "segment"]).withColumns({"template": grown, "rest": _behind("rest", beyond + 1)}).drop("name", "alone", "segment")
        only = node.where("_children = 1").select("host", "template")
        if not only.isEmpty():
            moved = moved.unionByName(_down_chains(deeper.drop("segment").join(only, ["host", "template"], "left_semi")))
        rows = materialise(moved, "urls")
    return done.select("host", "path", "template", "n", "blocked", "labelled")


def _behind(segments: str, n: Column) -> Column:
    """What is left of an array behind its first ``n``, or nothing."""
    return F.slice(segments, n + 1, F.size(segments))


def _down_chains(rows: DataFrame) -> DataFrame:
    """Rows whose nodes have one child each, moved on to where the paths of a node part, or to their ends.

    The last path of a node in order is an extension of no other; where another that is not the beginning of
    it leaves it, the paths part.
    """
    nodes = ["host", "template"]
    last = materialise(rows.groupBy(*nodes).agg(F.max("rest").alias("_last")), "last-paths")
    differs = F.array_position(F.zip_with("rest", "_last", lambda a, b: a.eqNullSafe(b)), F.lit(False)).cast("int") - 1
    leaves = F.when((differs >= 0) & (differs < F.size("rest")), differs)
    shared = materialise(rows.join(last, nodes).groupBy(*nodes).agg(F.min(leaves).alias("_shared")), "chains")
    steps = F.least(F.coalesce("_shared", F.size("rest")), F.size("rest"))
    return rows.join(shared, nodes).withColumns({"template": F.concat("template", F.repeat(F.lit("/*"), steps)), "rest": _behind("rest", steps)}).drop("_shared")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, strength: float = 4.0, reject: float = 0.5) -> DataFrame:
    """``pages`` with host, path, rule, template, block_rate and verdict.

    The verdict is the rule's where one fits, else 'block' if the template's smoothed block rate is at
    least ``reject`` and 'allow' if not.  Null urls have an empty host and path and are judged like any
    others; repeated rows alike; columns of these names are replaced, others stay.
    """
    rule, label = matching_rule(rules)
    looked = host_and_path(pages.drop("rule", "verdict", "template", "block_rate")).withColumn("rule", rule)
    urls = looked.select("host", "path", label.alias("verdict"))
    began = mark()
    found = materialise(templates(urls), "templates")
    sums = [F.sum(c).alias(f"{c}") for c in ("blocked", "labelled")]
    everything = found.agg(*sums).head()
    overall = ((everything["blocked"] or 0) + 0.5) / ((everything["labelled"] or 0) + 2)
    smooth = lambda prior: (F.col("blocked") + strength * prior) / (F.col("labelled") + strength)
    hosts = materialise(found.groupBy("host").agg(*sums).select("host", smooth(F.lit(overall)).alias("host_rate")), "hosts")
    rated = materialise(found.groupBy("host", "template").agg(*sums), "counts")
    rated = rated.join(hosts, "host").select("host", "template", smooth(F.col("host_rate")).alias("block_rate"))
    rated = materialise(rated, "rates")  # a plain table to join, whose partners with a hot template can be split
    drop_since(pages.sparkSession, began, found, rated)
    by_path = found.select("host", "path", "template").join(rated, ["host", "template"])
    verdict = F.coalesce(label, F.when(F.col("block_rate") >= reject, "block").otherwise("allow"))
    return looked.join(by_path, ["host", "path"], "left").withColumn("verdict", verdict)
