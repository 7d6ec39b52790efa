"""Connected components of an edge table, by rounds of hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleanroom.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; a component's nodes share one root.

    Every node hooks to the neighbour (or itself) that is first in a hashed order, then
    edges move to the parents and loops go.  In a hashed order a constant share of the
    nodes vanishes each round, long chains included.  Each round is written to the
    checkpoint folder; nothing but an emptiness test comes to the driver.
    """
    edges = settle(edges.where("a <> b").select("a", "b"), "edges")
    mapping = None
    while True:
        both = edges.union(edges.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("node"))
        first = both.groupBy("a").agg(F.min(rank("b")).alias("best"))
        parents = settle(first.select(F.col("a").alias("node"), F.least(rank("a"), "best")["node"].alias("parent")), "parents")
        if mapping is None:
            mapping = parents.withColumnRenamed("parent", "root")
        else:
            step = parents.withColumnRenamed("node", "root")
            mapping = settle(mapping.join(step, "root", "left").select("node", F.coalesce("parent", "root").alias("root")), "roots")
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(left, "a").join(right, "b").where("pa <> pb")
        edges = settle(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return mapping
