"""Connected components over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm._shared import drop, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of an edge: ``root`` is the smallest node it reaches.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each links nodes to
    the smallest known node of their neighbourhood and keeps the edge count from growing, so
    rounds grow with the logarithm of the size. Each round is stored; only one checksum row
    reaches the driver. DataFrame operations only.
    """
    hi, lo = F.greatest(a, b), F.least(a, b)
    links = materialize(edges.where(F.col(a) != F.col(b)).select(hi.alias("u"), lo.alias("v")).distinct(), "links")
    seen = None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        before, links = links, materialize(small, "links")
        drop(before)
        sums = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if sums == seen:
            break
        seen = sums
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
