"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two aggregations and two equi-joins over the edges; its result is written to the
shared folder, so the plan stays short and a lost executor costs one round at most. A hub with very
many neighbours is never gathered in one place: its minimum is pre-aggregated and written, so that
both sides of the join are plain shuffles, whose skewed partitions adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    edges: columns a and b of one orderable type. Null ends and loops are ignored, repeated edges
    count once. An empty table gives an empty result.
    """
    now = materialize(
        edges.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    sign = None
    while True:
        # large-star: every larger neighbour of a node links to the node's smallest neighbour
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = materialize(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        # small-star: every smaller neighbour of a node, and the node, link to its smallest neighbour
        below = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(below, "u").select(F.explode(F.array("u", "v")).alias("x"), "m").filter("x <> m")
        after = materialize(small.select(F.col("x").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        key = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(now, least, large, below)
        now = after
        if tuple(key) == sign:
            break
        sign = tuple(key)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
