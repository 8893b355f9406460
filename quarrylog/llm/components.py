"""Connected components of an edge table by alternating large-star and small-star steps.

Each round is two shuffles of the edges, aggregated before they move; the number of rounds grows with the
logarithm of the longest path. Rounds end in the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """edges: a, b (long). Returns id, root for every id on an edge; root is the smallest id it reaches."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    now = written(now, name)
    state = None
    while True:
        # Large star: every larger neighbour of v goes to v's smallest neighbour (or v itself).
        both = now.select("v", "u").union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("m", "v"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        # Small star: v and its smaller neighbours go to the smallest of them.
        small = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(small, "v")
        step = joined.select(F.col("u").alias("v"), F.col("m").alias("u")).union(small.select("v", F.col("m").alias("u"))).where("v <> u").distinct()
        now = written(step, name)
        seen = now.agg(F.count(F.lit(1)), F.sum("v"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return now.select(F.col("v").alias("id"), F.col("u").alias("root")).union(now.select(F.col("u").alias("id"), F.col("u").alias("root"))).distinct()
