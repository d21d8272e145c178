"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citysignal.llm.common import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for nodes of ``links`` (a, b); the component is its smallest node.

    Each step moves neighbours to the smallest one they know, with two groupings whose
    partial sums meet before the shuffle; the rounds grow with the logarithm of the length
    of paths. Every round is checkpointed. A loop or a null end adds nothing.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = cut_lineage(edges.distinct())

    def state(df: DataFrame):
        return tuple(
            df.agg(
                F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
            ).first()
        )

    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        edges = cut_lineage(small)
        after = state(edges)
        if after == before:
            break
        before = after
    members = edges.groupBy("u").agg(F.min("v").alias("component"))
    roots = members.select(F.col("component").alias("node")).distinct()
    return members.withColumnRenamed("u", "node").unionByName(
        roots.withColumn("component", F.col("node"))
    )
