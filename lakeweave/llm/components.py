"""Connected components of an edge list by alternating large-star and small-star rounds.

Each round joins every node to the smallest neighbour it knows.  A hub never
meets its neighbours in one group: minima are partial aggregates and the way
back is a join, which adaptive execution splits at skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (u, v): component is the smallest node that u reaches.

    Nodes without an edge to another node are absent."""
    e = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        e = stored(small.where("u <> v").distinct(), "edges")
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
