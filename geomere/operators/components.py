"""Connected components of a graph given by its links, as rounds of grouped aggregation and joins.

Each round is a large-star and a small-star step: every node points its larger, then its
smaller-or-equal neighbours to the least node it knows. The rounds end when the links
are stars around the least node of each component. Links stay distributed; a
round's table is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def _starred(links: DataFrame, large: bool) -> DataFrame:
    """One step over links (u, v) where u > v."""
    both = links if not large else links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    known = both.join(least, "u")
    if large:
        out = known.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = known.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root of every node that has a link; root is the least node of its component. ``links``: a, b (long)."""
    now = written(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == before:
            break
        before = mark
        now = written(_starred(_starred(now, large=True), large=False), "links")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
