"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``comp``, the smallest id it is connected with, for every end of a link ``a``, ``b``.

    Alternates the large-star and small-star steps: each round hooks the larger,
    then the smaller neighbours of every id to its smallest one, until all links
    lead to the smallest id. Rounds grow with the logarithm of the size; each is
    written out. Links per id shrink to one, so a hot id is aggregated, never gathered.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        hooked = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v")))
        after = saved(hooked.where("u <> v").distinct(), "edges")
        if after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty():
            return after.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionAll(
                after.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct()
            )
        edges = after
