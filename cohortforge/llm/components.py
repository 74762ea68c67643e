"""Connected components by alternating star steps over a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.shared import staged


def large_star(edges: DataFrame) -> DataFrame:
    """Each vertex hangs its larger neighbours on the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each vertex hangs itself and its smaller neighbours on the smallest of those."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every vertex of `edges` (u, v) that is not the smallest of its component.

    No step gathers a component; a vertex with very many edges is split by the skew handling of
    joins. Each round is written to the shared folder. An empty table gives an empty one.
    """
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges, before = staged(ordered.distinct(), "edges"), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not mark[0] or mark == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        before = mark
        edges = staged(small_star(large_star(edges)), "edges")
