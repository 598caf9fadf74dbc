"""Connected components of a graph of any size, in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swelter.llm.common import durable

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for every node of the edges (a, b).

    Large-star and small-star steps alternate until nothing changes, which takes a number of rounds that grows with the logarithm
    of the largest component. Each step is a minimum per node, combined before its shuffle, and a join back.
    """
    now = durable(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        now = durable(small)
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
        before = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
