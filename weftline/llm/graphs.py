"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.scratch import Scratch


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, component)`` of every end of ``edges (a, b)``; component is the smallest id reachable.

    Large-star and small-star steps shrink the edges to one star per component. A step takes a
    minimum per node, combined before the shuffle, and one join; every round ends in a written
    table, so a lost executor costs one round at most. Self-loops and repeats do no harm.
    """
    now = scratch.keep(edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).where("u <> v").distinct(), "edges0")
    number, seen = 0, None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.keep(large, f"large{number}")
        small = _least(large)
        links = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = links.unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        nxt = scratch.keep(links, f"edges{number + 1}")
        mark = nxt.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        scratch.drop(f"large{number}")
        scratch.drop(f"edges{number}")
        now, number = nxt, number + 1
        if mark == seen or mark[0] == 0:
            break
        seen = mark
    tops = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(tops)
