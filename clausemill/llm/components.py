"""Connected components as joins: each round hangs every node on smaller neighbours until nothing moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component_id) for every node of the undirected edges (a, b), written: the least id that the node reaches.

    Alternates large-star and small-star rounds; a round's result is written to the scratch folder. The number of
    rounds grows with the logarithm of the longest chain. No list of neighbours is ever collected.
    """
    now = materialize(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    state = None
    while True:
        old, now = now, materialize(_small_star(_large_star(now)))
        forget(old)
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == state:
            break
        state = sums
    roots = now.select(F.col("b").alias("id")).distinct().withColumn("component_id", F.col("id"))
    out = materialize(now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(roots))
    forget(now)
    return out
