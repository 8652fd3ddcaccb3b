"""Connected components of links, by contraction in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.sources.sinks import materialise


def _priority(node: str, salt: int) -> Column:
    return F.struct(F.xxhash64(F.col(node), F.lit(salt)).alias("priority"), F.col(node).alias("node"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges`` (``a``, ``b`` bigint).

    Each round points every node to the neighbour of lowest random priority, follows two pointers, and joins
    the links to what they point at; a fresh order per round keeps chains from shrinking by one node at a
    time, so the number of nodes falls by a constant factor. Each round's tables are written to the shared
    folder. Links to itself, repeated links and either direction make no difference; links with a null end
    are ignored; no links give an empty frame.
    """
    left = edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    left = materialise(left.distinct(), "links")
    roots = materialise(
        left.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("root")),
        "roots",
    )
    salt = 0
    while not left.isEmpty():
        salt += 1
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min(_priority("b", salt)).alias("low"))
        own = _priority("a", salt)
        parent = lowest.select("a", F.least(own, F.col("low"))["node"].alias("p"))
        parent = materialise(parent.select(F.col("a").alias("v"), "p"), "parent")
        jumped = parent.alias("x").join(parent.alias("y"), F.col("x.p") == F.col("y.v"))
        jumped = materialise(jumped.select("x.v", F.col("y.p").alias("p")), "jumped")
        step = left.join(jumped, F.col("a") == F.col("v")).select(F.col("p").alias("a"), "b")
        step = step.join(jumped, F.col("b") == F.col("v")).select("a", F.col("p").alias("b"))
        step = step.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        left = materialise(step.distinct(), "links")
        moved = roots.join(jumped, F.col("root") == F.col("v"), "left")
        roots = materialise(moved.select("node", F.coalesce("p", "root").alias("root")), "roots")
    smallest = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(smallest, "root").select("node", "component")
