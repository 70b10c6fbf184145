"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.lake import materialise


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``links`` (columns a, b) that has a link to another node.

    Each step connects a node's neighbours to their minimum, with aggregates and joins on the node, so a node with very many links is shared
    out like any skewed key. Steps end when the links are stars, after about log(n) of them; each is a table in the shared folder.
    """
    large = F.greatest("a", "b").alias("u")
    stars = materialise(links.where("a <> b").select(large, F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        outer = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        nearest = outer.groupBy("u").agg(F.min("v").alias("m"))
        inner = outer.join(nearest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialise(inner.unionByName(nearest.withColumnRenamed("m", "v")).where("u <> v").distinct(), "links")
