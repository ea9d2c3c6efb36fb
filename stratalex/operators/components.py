"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) to (node, root): every node of an edge with the least node of its component."""
    stars = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct(), "edges")
    if stars.isEmpty():
        return stars
    before = None
    while True:
        both = stars.unionAll(stars.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = both.join(least, "node").where("root > node and root <> m").select(F.col("root").alias("node"), F.col("m").alias("root")).distinct()
        low = large.groupBy("node").agg(F.min("root").alias("m"))
        small = large.join(low, "node").select(F.col("root").alias("node"), F.col("m").alias("root")).unionAll(low.select("node", F.col("m").alias("root")))
        stars = cut(small.where("node <> root").distinct(), "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))).first()
        if now == before:
            return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())
        before = now
