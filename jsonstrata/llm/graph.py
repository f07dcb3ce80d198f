"""Connected components of edges in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonstrata.llm.frames import keep


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node it reaches.

    Alternates large-star and small-star steps until the edges are stars around the smallest nodes;
    the number of rounds grows with the logarithm of the size, and no list of neighbours is ever put
    together. Each round is written, so a lost executor costs a part of a round.
    """
    e = keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low"))
        lowest = lowest.select(F.col("a").alias("at"), F.least("a", "low").alias("low"))
        large = both.where("b > a").join(lowest, F.col("a") == F.col("at"))
        large = large.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        near = lowest.select(F.col("a").alias("at"), "low")
        small = large.join(near, F.col("a") == F.col("at")).where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        e = keep(small.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct())
        state = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if state == seen:
            break
        seen = state
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
