"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node it reaches.

    Alternates large-star and small-star steps: every node hangs its larger (smaller)
    neighbours onto its smallest one, until nothing changes.  Each step is a grouping
    by node with partial aggregation and a join that adaptive execution can split, so
    a node with very many neighbours is no hot task; the lineage is cut by a written
    table after each round.  Self loops and repeated edges are allowed; nodes are longs.
    """
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lower, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lower.select("a", F.col("m").alias("b"))).distinct()
        now = saved(small, "edges")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
    raise RuntimeError("components did not settle")
