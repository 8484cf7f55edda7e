"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislekit.llm._common import Scratch


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """Each node of ``edges`` (a, b: long, not null) with the smallest node it reaches: node, component.

    Every step joins edges to the smallest neighbour of a node; no node's
    neighbours are gathered.  The number of steps grows with the logarithm of
    the longest path.
    """
    def smallest(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))

    def table(e: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        t = scratch.table(e.distinct(), name)
        return t, tuple(t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e, before = table(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), f"{label}-0")
    step = 0
    while before[0]:
        step += 1
        both = e.union(e.select("v", "u"))
        large = both.join(smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        small = down.join(smallest(down), "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(small.select("u", F.col("m").alias("v"))).where("u <> v"))
        e, now = table(small, f"{label}-{step}")
        scratch.drop(f"{label}-{step - 1}")
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
