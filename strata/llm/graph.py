"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import durable


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node reachable.

    Alternating large-star and small-star rounds: each links a node's neighbours to its smallest
    one, until every component is a star. A round is two aggregations with map-side combine and
    joins on them; its result goes to the checkpoint folder. Only a count and a checksum reach the driver.
    """
    a, b = F.col(a).cast("long"), F.col(b).cast("long")
    stars = durable(edges.where(a != b).select(F.greatest(a, b).alias("u"),
                                               F.least(a, b).alias("v")).distinct())
    before = None
    while True:
        state = tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == before:
            return (stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .union(stars.select("v", "v")).distinct())
        before = state
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        stars = durable(small.where(F.col("v") != F.col("m"))
                        .select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .union(least.select("u", "m")).distinct())
