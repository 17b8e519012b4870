"""Connected components of an edge table, by alternating star operations.

A large-star step links each node's larger neighbours to the least node it knows;
a small-star step links its smaller neighbours and itself to the least of them.
Alternating the two leaves every component as one star around its least node
after about log(n) rounds, also for long chains. Hubs are met by aggregating
before joining; the join's hub side is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import settled


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return (
        both.filter("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` go from the larger node a to the smaller b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node on an edge; component is its least node.

    ``edges`` has columns a and b of one orderable type. Self-edges, repeated
    edges, either direction and nulls are accepted; edges with a null are ignored.
    An empty table gives an empty result. Each round is a reliable checkpoint, so
    a lost executor costs one round at most.
    """
    tidy = edges.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = settled(tidy.distinct())
    mark = None
    for _ in range(most_rounds):
        mark_of = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        seen = now.agg(F.count("*"), mark_of).first()
        if tuple(seen) == mark or seen[0] == 0:
            break
        mark = tuple(seen)
        now = settled(_small_star(_large_star(now)))
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
