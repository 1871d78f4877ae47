"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop_since, mark, materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or the node)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b").where("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b").select("a", "b", "m")
    return joined.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a < b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for every node of an edge table (a, b).

    Loops and edges with a null end are dropped; no edges give no rows.  Each round is written to the
    shared folder and so is the result; the rounds end when an order-free sum over the edges stops changing.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    spark = edges.sparkSession
    began = mark()
    edges = materialise(edges, "edges")
    state = None
    while True:
        edges = materialise(_small_star(_large_star(edges)), "edges")
        row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).head()
        if (row["n"], row["s"]) == state:
            break
        state = (row["n"], row["s"])
    members = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    members = members.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
    members = materialise(members, "members")
    drop_since(spark, began, members)
    return members
