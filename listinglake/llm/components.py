"""Connected components by alternating large-star and small-star rounds.

Every round shrinks the edge list towards one star per component; the list is written to the shared
folder each round, and rounds go on until it no longer changes. The one-row-per-node side of each
join goes through an exchange of its own, so a node that holds a third of the edges can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _spread(df: DataFrame) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(_spread(least), "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(_spread(least), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: bigint, no loops, no nulls) → (node, label): label is the component's smallest node."""
    def state(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    at = stored(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    seen = state(at)
    while seen[0]:
        at = stored(_small_star(_large_star(at)), "edges")
        now = state(at)
        if now == seen:
            break
        seen = now
    return at.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        at.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
