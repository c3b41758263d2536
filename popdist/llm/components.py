"""Connected components by alternating large-star and small-star steps.

Every step is joins and aggregates over staged edge tables; no vertex's
neighbours are ever gathered in one row, and only a count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popdist.llm.common import staged


def _least(edges: DataFrame) -> DataFrame:
    return staged(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star-least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = staged(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "star-both")
    return both.where("v > u").join(_least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(u, root) of every vertex of the undirected ``edges`` (u, v long); root
    is the component's smallest vertex.  Self links are allowed."""
    clean = lambda e: e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    now = staged(clean(edges), "star-edges")
    mark = None
    while True:
        now = staged(clean(_small_star(staged(clean(_large_star(now)), "star-large"))), "star-small")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    found = now.select("u", F.col("v").alias("root"))
    return found.unionByName(now.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
