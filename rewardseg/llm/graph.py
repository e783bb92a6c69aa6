"""Connected components of a link table, distributed.

Alternating large-star and small-star rounds: every round points nodes at
the smallest node they see, until no link changes.  A round is two
aggregations and two joins on the node; a hub costs one partial-aggregated
row per task, and its join side is split by adaptive execution.  No
component, link or node list reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rewardseg.llm.common import stage, unstage

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> (node, component), component being the smallest
    node reachable; only nodes that have a link to another node appear.
    Links may repeat and may be given in either direction; nulls and loops
    are ignored."""
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u > v").distinct(), "links")
    state = None
    for _ in range(MAX_ROUNDS):
        # large star: the larger neighbours of u point at u's smallest neighbour
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        # small star: u and its smaller neighbours point at the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        before, edges = edges, stage(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionAll(least.select("u", F.col("m").alias("v"))).where("u > v").distinct(), "links")
        unstage(before)
        # unchanged when the link table is the same set as before
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
