"""Connected components of a link table, by large-star and small-star rounds.

Each round is a few joins and grouped minima; its result is staged in the shared folder. A node
with very many links is an ordinary skewed join key, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stage


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node of the links with the smallest node it reaches.

    Loops and repeated links make no difference; links with a null end are left out.
    """
    edges = stage(
        links.where(F.col(a) != F.col(b)).select(
            F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
        ).distinct(), "links",
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).where(F.col("u") != F.col("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            root.select("u", F.col("m").alias("v"))
        ).where(F.col("u") != F.col("v")).distinct()
        edges = stage(small, "links")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v"), F.col("v")).distinct()
    )
