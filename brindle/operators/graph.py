"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.session import shared_folder


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (smallest node reachable) of every node of the edges (columns ``a`` and ``b`` of one type).

    Rounds grow with the logarithm of the number of nodes, so long chains are no worse than stars. Each round is two aggregations and two equi-joins, cut off by a checkpoint.
    """
    shared_folder(edges.sparkSession)
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null").distinct().checkpoint()
    star, before = pairs.where("u <> v"), None
    while True:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        first = down.groupBy("u").agg(F.min("v").alias("m"))
        star = down.join(first, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(first.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        now = star.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = pairs.select("u").union(pairs.select("v")).distinct()
    return nodes.join(star.select("u", F.col("v").alias("_c")), "u", "left").select(F.col("u").alias("node"), F.coalesce("_c", "u").alias("component"))
