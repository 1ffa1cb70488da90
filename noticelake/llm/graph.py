"""Connected components of a link table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long) to (node, component): each linked node with the smallest node it reaches.

    Rounds of large-star and small-star: every node's larger neighbours move to its smallest one, then its smaller ones do,
    until each component is a star around its smallest node. Rounds grow as the logarithm of the size. Minima are combined
    before the shuffle, so a node with very many links is a few rows there; the joins put the unique side against the many.
    Each round is written to the shared folder. Null and self links are dropped.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u is not null and u > v").distinct()
    edges, before = cut_lineage(edges), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        edges = cut_lineage(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
