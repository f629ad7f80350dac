"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import discard, materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges ``u, v`` with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    out = both.join(low, "u")
    if large:   # every larger neighbour moves to the smallest one
        out = out.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:       # the node and its smaller neighbours move to the smallest of them
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` of every linked node; ``root`` is the smallest node of its
    component. Both steps are aggregates and joins on narrow rows, and the
    number of rounds grows with the logarithm of the longest chain."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "edges")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        seen = mark
        before, edges = edges, materialize(_stars(_stars(edges, True), False), "edges")
        discard(before)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
