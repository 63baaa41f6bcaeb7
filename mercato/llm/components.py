"""Connected components of an edge list by alternating large-star and small-star steps.

Every step is two shuffles on a node id; edges shrink towards stars around the
smallest node of a component, in a number of rounds logarithmic in the longest
path.  Each round is written to the shared checkpoint folder, so lineage stays
short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.common import reuse_checkpointed


def _star(pairs: DataFrame, smaller_only: bool) -> DataFrame:
    """Link the neighbours ``v`` of each ``u`` to the smallest of ``u`` and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    linked = pairs.join(least, "u").withColumn("m", F.least("u", "m"))
    if smaller_only:
        # pairs hold v < u only: link each smaller neighbour, and u itself, to the smallest.
        near = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(linked.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        near = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return near.where("a != b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of ``edges(a, b)``."""
    edges = reuse_checkpointed(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    )
    for _ in range(max_rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, smaller_only=False)
        small = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        new = reuse_checkpointed(_star(small, smaller_only=True))
        # Done when every node hangs on one smaller node that hangs on none.
        hub = new.select(F.col("a").alias("hub"))
        again = new.join(hub, new["b"] == hub["hub"], "left_semi").limit(1).count()
        many = new.groupBy("a").count().where("count > 1").limit(1).count()
        edges = new
        if not again and not many:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
