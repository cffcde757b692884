"""Connected components of a graph given by its edges, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.rows import staged


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for every node of an edge but the roots.

    `edges` has columns a and b of one orderable type. Each round links every node's larger
    neighbours, then its smaller ones, to the smallest (large-star, small-star), until a round
    changes nothing. Only minima are gathered, never a node's neighbours, so a hub is no problem.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = staged(edges.where("a <> b").select(larger, smaller).distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Larger neighbours of a are tied to the smallest node that a sees, itself included.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ends = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")
        now = staged(ends.distinct(), "edges")
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mark")
        ).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
