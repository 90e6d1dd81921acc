"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.groups import free, stored


def fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) for all nodes of ``edges`` (u, v: long, u <> v).

    Large and small stars take turns: each node's neighbours are tied to the smallest of them,
    until every component is a star. A node with many neighbours is a row of minima, found by a
    partial aggregate, and a join that Spark can split. Each turn is stored, so the plan stays short,
    and inside a scope the turn before it is deleted.
    """
    current = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = fingerprint(current)
    while True:
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct())
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        tied = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, current = current, stored(tied.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        free(before, lowest, large, least)
        now = fingerprint(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots.distinct())
