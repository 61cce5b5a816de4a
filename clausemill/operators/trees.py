"""Trees of clauses by parent_id: ancestors, depth, root and subtree sizes by pointer doubling, circles reported.

After k rounds every clause knows its ancestors up to 2**k steps away, so a chain of any length takes the logarithm of its
length in joins. Each round is written, and nothing but a row of counts comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.sources.files import written


def _parents(rows: DataFrame) -> DataFrame:
    """(id, up): each clause and its parent, null where that is missing or not in the table. Rows that repeat an id count once,
    with the least parent."""
    own = rows.where("id is not null").groupBy("id").agg(F.min(F.when(F.col("parent_id") != "", F.col("parent_id"))).alias("up"))
    known = own.select(F.col("id").alias("up"), F.lit(True).alias("known"))
    return own.join(known, "up", "left").select("id", F.when(F.col("known"), F.col("up")).alias("up"))


def circles(parents: DataFrame) -> DataFrame:
    """(id) of the clauses in a circle or below one: those that still have an ancestor as many steps up as there are clauses."""
    up = written(parents)
    n, steps = up.count(), 1
    while steps <= n and not up.where("up is not null").isEmpty():
        far = up.select(F.col("id").alias("up"), F.col("up").alias("far"))
        up = written(up.join(far, "up", "left").select("id", F.col("far").alias("up")))
        steps *= 2
    return up.where("up is not null").select("id")


def ancestors(rows: DataFrame) -> DataFrame:
    """N-13: (id, ancestor_id, distance) of clauses (id, parent_id): every ancestor in the table, the parent at distance 1.
    Clauses in a circle or below one have none. An empty parent_id, or one that is missing, ends the chain."""
    parents = written(_parents(rows))
    pairs = written(parents.where("up is not null").join(circles(parents), "id", "left_anti").select("id", F.col("up").alias("ancestor_id"), F.lit(1).cast("long").alias("distance")))
    reach = 1
    while True:
        # The farthest ancestor known hands on all that it knows.
        far = pairs.where(F.col("distance") == reach).select("id", F.col("ancestor_id").alias("via"))
        known = pairs.select(F.col("id").alias("via"), "ancestor_id", (F.col("distance") + reach).alias("distance"))
        more = written(far.join(known, "via").select("id", "ancestor_id", "distance"))
        if more.isEmpty():
            return pairs
        pairs, reach = written(pairs.unionByName(more)), reach * 2


def tree_measures(rows: DataFrame) -> DataFrame:
    """N-13: (id, depth, root_id, subtree_size, circular) of each clause: how many ancestors it has, the topmost one or itself,
    how many clauses are below it or are itself, and whether it is in a circle or below one; then depth, root and size are
    null."""
    parents = written(_parents(rows))
    pairs = ancestors(rows)
    up = pairs.groupBy("id").agg(F.count(F.lit(1)).alias("above"), F.max_by("ancestor_id", "distance").alias("root"))
    # Counted before the shuffle: a root's many descendants are one row per task.
    below = pairs.groupBy(F.col("ancestor_id").alias("id")).agg(F.count(F.lit(1)).alias("below"))
    turning = circles(parents).withColumn("circular", F.lit(True))
    out = parents.select("id").join(up, "id", "left").join(below, "id", "left").join(turning, "id", "left").withColumn("circular", F.coalesce("circular", F.lit(False)))
    straight = lambda c: F.when(~F.col("circular"), c)
    return out.select("id", straight(F.coalesce("above", F.lit(0))).alias("depth"), straight(F.coalesce("root", "id")).alias("root_id"), straight(F.coalesce("below", F.lit(0)) + 1).alias("subtree_size"), "circular")
