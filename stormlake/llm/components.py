"""Connected components of a graph of long ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages


def components(stages: Stages, edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, root): root is the smallest id of node's component;
    a row for every id in edges.

    In turn, every node ties its larger neighbours to its smallest one, and its
    smaller neighbours and itself to that; the edges become stars in a number
    of rounds that grows with the logarithm of the longest path.  A node's neighbours are
    only ever reduced to a minimum, never gathered."""
    u, v = F.col("u"), F.col("v")
    now = stages.save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == (state["n"], state["s"]):
            break
        mark = state["n"], state["s"]
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v")).where(u != v).distinct()
        large = stages.save(large, "large")
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(small, "u").select(v.alias("u"), F.col("m").alias("v")).where(u != v)
        after = stages.save(tied.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        stages.drop(now, large)
        now = after
    roots = now.select(v.alias("node"), v.alias("root")).distinct()
    return now.select(u.alias("node"), v.alias("root")).unionByName(roots)
