"""Connected components of an edge table by alternating stars (Kiveris et al., 2014).

Edges stay distributed; each round is two aggregations and two joins, written to the shared
checkpoint folder, so that a lost executor costs a re-read.  A hub's rows are pre-aggregated
before the shuffle; its joins are sort-merge joins, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorgrid.staging import release, stage


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the node's smallest neighbour."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node points to two nodes, or to one that points on."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("up")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("up"))
    )
    seen = ends.groupBy("node").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.count_if(F.col("up").isNull()).alias("below"))
    return seen.where("low <> high or (low is not null and below > 0)").limit(1).count() > 0


def components(edges: DataFrame, label: str = "components", check_first: bool = True) -> DataFrame:
    """``(node, root)`` of every node of the edges ``(a, b)``; the root is the smallest node.

    A staged table is returned.  Nodes without an edge do not appear.  Edges with a null end
    are left out; loops and repeated edges change nothing.  Without ``check_first`` the edges are
    taken to need a round at least.
    """
    current = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a is not null and b is not null and a <> b").distinct(),
        label,
    )
    while not check_first or _unfinished(current):
        check_first = True
        halfway = stage(_large(current), label)
        release(current)
        current = stage(_small(halfway).where("a <> b").distinct(), label)
        release(halfway)
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
    out._staged_at = current._staged_at
    return out
