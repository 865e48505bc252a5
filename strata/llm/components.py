"""Connected components of a link table by alternating large-star and small-star steps.

Each step is an aggregate and a join on the vertex, written to the shared checkpoint folder; the
number of rounds grows with the logarithm of the longest chain.  Only one hash per round
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import checkpoint_dir


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): for every node of ``links`` the smallest node it can reach."""
    checkpoint_dir(links.sparkSession)
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct().checkpoint())
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").where("u > v").distinct())
        edges = small.checkpoint()
        if (now := _mark(edges)) == mark:
            break
        mark = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
