"""Running counts and carried values along documents of any length.

A document's first CHUNK places are one window. What lies behind them is cut into chunks: every chunk gives a summary, the
summaries of a document are combined in order, and each chunk finishes by itself with what came before it. So no window
holds more than CHUNK rows of a document, but for the row per chunk of the summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.sources.files import written

CHUNK = 1 << 17


def running(rows: DataFrame, order: str, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None, chunk: int = CHUNK) -> DataFrame:
    """W-1, W-3: ``rows`` with the running sums, and the last values that are not null, up to and with each row of its
    doc_id in the order of ``order``, a column of whole numbers from 0 on. Rows without a place are left out.

    The furthest place is looked up first. Documents longer than a chunk, at most one for each ``chunk`` rows, are broadcast to find
    their summaries; where there are none, the rows are read and dealt once."""
    sums, lasts = sums or {}, lasts or {}
    at = F.col(order)

    def local(part: DataFrame, *keys: str) -> DataFrame:
        so_far = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return part.withColumns({n: F.sum(c).over(so_far) for n, c in sums.items()} | {n: F.last(c, ignorenulls=True).over(so_far) for n, c in lasts.items()})

    furthest = rows.agg(F.max(at)).first()[0]
    if furthest is None or furthest < chunk:
        return local(rows.where(at.isNotNull()), "doc_id")
    number = F.floor(at / chunk).cast("long")
    later = rows.where(at >= chunk).withColumn("_chunk", number)
    long = F.broadcast(later.select("doc_id").distinct())
    summary = [F.sum(c).alias(n) for n, c in sums.items()] + [F.max_by(c, F.when(c.isNotNull(), at)).alias(n) for n, c in lasts.items()]
    parts = rows.join(long, "doc_id", "left_semi").groupBy("doc_id", number.alias("_chunk")).agg(*summary)
    before = Window.partitionBy("doc_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("doc_id", "_chunk", *[F.sum(n).over(before).alias(f"_{n}") for n in sums], *[F.last(n, ignorenulls=True).over(before).alias(f"_{n}") for n in lasts])
    whole = {n: F.coalesce(F.col(f"_{n}"), F.lit(0)) + F.col(n) for n in sums} | {n: F.coalesce(n, f"_{n}") for n in lasts}
    rest = local(later, "doc_id", "_chunk").join(carried, ["doc_id", "_chunk"]).withColumns(whole).drop("_chunk", *[f"_{n}" for n in whole])
    return local(rows.where(at < chunk), "doc_id").unionByName(rest)


def positions(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` in order with position, their place in the whole table from 0 on, written. Spark's range partitioner deals them;
    what lies before a partition is the sum of the sizes before it, a number each."""
    spark = rows.sparkSession
    at = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    before, starts = 0, []
    for p, n in sorted(at.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()):
        starts.append((p, before))
        before += n
    table = F.broadcast(spark.createDataFrame(starts, "_part long, _before long"))
    return at.withColumn("_part", part).join(table, "_part").withColumn("position", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_before", "_at")
