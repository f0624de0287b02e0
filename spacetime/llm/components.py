"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spacetime.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (long columns ``a, b``);
    ``root`` is the smallest node reachable.

    Large-star / small-star rounds: every node first links its larger
    neighbours, then its smaller ones, to the smallest neighbour it knows.  Each
    round is two aggregations and joins on the edge table and is stored, so no
    round depends on an executor's memory; the number of rounds grows with the
    logarithm of a component's width.  Loops and repeated edges are harmless.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        # large star: larger neighbours (and the node) point to the smallest
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large-star")
        # small star: the node and its smaller neighbours point to the smallest
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = stored(small.union(down.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select("b").distinct().join(edges.select(F.col("a").alias("b")), "b", "left_anti")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
