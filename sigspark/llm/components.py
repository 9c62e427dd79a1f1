"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations with map-side combination and two joins that
Spark can split where a node has many edges; its edges are written to the
shared folder, which cuts the lineage. Nothing but a count and a checksum
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


#: Edges of a task of a round that has too few for all tasks.
EDGES_A_TASK = 200_000


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges(u, v); component is the least node reachable."""
    now = materialize(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = _print(now)
    while seen[0]:
        now = _small_star(_large_star(now))
        # a round makes about as many edges as it was given
        parts = -(-seen[0] // EDGES_A_TASK)
        if parts < int(now.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            now = now.coalesce(parts)
        now = materialize(now, "edges")
        if (new := _print(now)) == seen:
            break
        seen = new
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
