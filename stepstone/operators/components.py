"""Weakly connected components in few rounds: large-star and small-star, each round a written table.

Every edge is kept as (hi, lo) with lo < hi.  Large-star hangs the larger neighbours of a node on its smallest one,
small-star hangs the smaller ones and the node itself.  Paths shrink by a factor each round, so chains need a number of
rounds that grows with the logarithm of their length.  Minima are written before they are joined: both sides of a join
are then plain exchanges, and a hub's rows can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepstone.session import cut, cut_counted


def _lowest(edges: DataFrame, tag: str) -> DataFrame:
    return cut(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("least"), F.count(F.lit(1)).alias("n")), tag)


def smallest_members(edges: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """(node, root) for every node with a neighbour other than itself; ``root`` is the smallest node of its component."""
    ends = [F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")]
    current = cut(edges.where(F.col(a) != F.col(b)).select(*ends).distinct(), "star")
    while True:
        least = _lowest(current, "least")
        below = least.select(F.col("node").alias("lo"), "least")
        # done when every node hangs on one node, which itself hangs on none
        hung, moved = cut_counted(
            current.join(below, "lo", "left").select("hi", F.coalesce("least", "lo").alias("lo"), F.col("least").isNotNull().alias("m")),
            "large-star",
            F.col("m"),
        )
        if not moved and not least.where("n > 1").limit(1).count():
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        hung = hung.select("hi", "lo")
        again = _lowest(hung, "least").select(F.col("node").alias("hi"), "least")
        low = hung.join(again, "hi").where("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        own = again.select("hi", F.col("least").alias("lo"))
        current = cut(low.union(own).distinct(), "small-star")
