"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge ``(u, v)``; a component is named by its smallest node.

    Each round joins all neighbours of a node to the smallest one, first the
    larger neighbours, then the smaller ones, until nothing changes. Each step is
    a written table, both for recovery and because adaptive execution can split
    the join of a node with very many neighbours only between written tables.
    """
    now = stage(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = stage(
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large"
        )
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        joined = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(joined.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
