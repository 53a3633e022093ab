"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MAX_ROUNDS = 40


def components(edges: DataFrame) -> DataFrame:
    """(v, c) for each vertex of edges (v, u): c is the least vertex of its component.

    Every round is a written table, so lineage stays short and a lost executor costs one read. A hub's edges are
    pre-aggregated before the shuffle for its minimum; the minima are written, so that the join back has plain
    exchanges on both sides, which adaptive execution can split.
    Ends when the edges are stars, each vertex linked to one other that is linked to none; the number of rounds grows
    with the logarithm of the longest path.
    """
    e = C.write_table(edges.select("v", "u").filter("v <> u").select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        ends = e.select("v", F.lit(1).alias("n"), F.lit(0).alias("centre")).unionByName(e.select(F.col("u").alias("v"), F.lit(0).alias("n"), F.lit(1).alias("centre")))
        if ends.groupBy("v").agg(F.sum("n").alias("n"), F.max("centre").alias("centre")).filter("n > 1 OR n = 1 AND centre = 1").isEmpty():
            break
        # Large star: every larger neighbour of x is linked to the least of x and its neighbours.
        both = e.unionByName(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = C.write_table(both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m")), "least")
        large = C.write_table(both.filter("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).filter("v <> u").distinct(), "edges")
        # Small star: every smaller neighbour of x and x itself are linked to the least of them.
        down = C.write_table(large.groupBy("v").agg(F.min("u").alias("m")), "least")
        joined = large.join(down, "v")
        small = joined.select(F.col("u").alias("v"), F.col("m").alias("u")).filter("v <> u").unionByName(down.select("v", F.col("m").alias("u")))
        e = C.write_table(small.distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return e.select("v", F.col("u").alias("c")).unionByName(e.select(F.col("u").alias("v"), F.col("u").alias("c")).distinct())
