"""Connected components of an edge list, by contraction, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, skew_joined


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> (node long, root long); nodes without an edge don't appear.

    Every round each node joins the neighbour (or itself) of the smallest mixed number, and edges are redrawn between those it
    joined; mixing with the round's number keeps the expected count of rounds logarithmic, on long paths too. A node's neighbours
    are reduced by partial aggregation and hubs are salted in the joins, so no hub is a single task's work; the rounds' tables
    shrink, and are read back in reverse.
    """
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = checkpointed(both.distinct())
    rounds: list[DataFrame] = []
    while not both.isEmpty():
        mix = lambda c, k=len(rounds): F.xxhash64(F.lit(k), c)
        low = F.min(F.struct(mix(F.col("b")).alias("m"), F.col("b").alias("x")))
        own = F.struct(mix(F.col("a")).alias("m"), F.col("a").alias("x"))
        step = both.groupBy("a").agg(low.alias("low"), F.count("*").alias("n"))
        step = checkpointed(step.select(F.col("a").alias("node"), F.least(F.col("low"), own)["x"].alias("up"), "n"))
        rounds.append(step.drop("n"))
        one = skew_joined(both, step.select(F.col("node").alias("a"), "up", "n"), "a").select(F.col("up").alias("a"), "b")
        two = skew_joined(one, step.select(F.col("node").alias("b"), "up", "n"), "b").select("a", F.col("up").alias("b"))
        both = checkpointed(two.where("a <> b").distinct())
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    tops = rounds.pop().select("node", F.col("up").alias("root"))
    while rounds:
        step = rounds.pop()
        sizes = step.groupBy("up").agg(F.count("*").alias("n"))
        above = sizes.join(tops.select(F.col("node").alias("up"), F.col("root").alias("top")), "up", "left")
        tops = checkpointed(skew_joined(step, checkpointed(above), "up").select("node", F.coalesce("top", "up").alias("root")))
    return tops
