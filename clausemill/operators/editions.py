"""What changed between two editions of the units: kept, renumbered, moved, changed, removed and added.

Texts that occur once in both editions of a volume are anchors. Within a part the anchors whose order is the same in both
editions, a longest increasing run, stand where they stood; the others have moved. What is left is paired by equal label and
text, then by label, then by text, in order; the rest was removed or added. All pairing is by equality joins, of texts as 128
bits; only a part's anchors, their places and labels, meet in one task. What has been paired leaves both editions, so each step
reads what the one before it left.
"""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.sources.files import written

_PAIR = ["volume", "ord_a", "ord_b", "label_a", "label_b"]


def longest_increasing(values: list[int]) -> list[bool]:
    """Which of the values are in a longest strictly increasing run; of several runs, that of the smallest values from its
    end."""
    tails: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        before.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    keep = [False] * len(values)
    i = at[-1] if at else -1
    while i >= 0:
        keep[i] = True
        i = before[i]
    return keep


def _in_order(anchors: DataFrame) -> DataFrame:
    """``anchors`` with in_order: for pairs of one part, whether they are in its longest increasing run."""
    schema = pa.schema([("volume", pa.string()), ("ord_a", pa.int64()), ("ord_b", pa.int64()), ("label_a", pa.string()), ("label_b", pa.string()), ("in_order", pa.bool_())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("ord_a", "ascending"), ("ord_b", "ascending")])
        kept = pa.array(longest_increasing(table.column("ord_b").to_pylist()), pa.bool_())
        return pa.table([*(table.column(c) for c in schema.names[:-1]), kept], schema=schema)

    same = anchors.where("part_a = part_b").select(F.col("part_a").alias("part"), *_PAIR)
    judged = same.groupBy("volume", "part").applyInArrow(run, "volume string, ord_a long, ord_b long, label_a string, label_b string, in_order boolean")
    return judged.unionByName(anchors.where("part_a <> part_b").select(*_PAIR, F.lit(False).alias("in_order")))


def _without(side: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    return side.join(pairs.select("volume", F.col(name).alias("ord")), ["volume", "ord"], "left_anti")


def _paired(a: DataFrame, b: DataFrame, keys: list[str], change: Column) -> DataFrame:
    """The n-th of each key in one edition with the n-th in the other."""
    nth = F.row_number().over(Window.partitionBy("volume", *keys).orderBy("ord"))
    left = a.withColumn("nth", nth).select("volume", *keys, "nth", F.col("ord").alias("ord_a"), F.col("unit_label").alias("label_a"))
    right = b.withColumn("nth", nth).select("volume", *keys, "nth", F.col("ord").alias("ord_b"), F.col("unit_label").alias("label_b"))
    return left.join(right, ["volume", *keys, "nth"]).select(*_PAIR, change.alias("change"))


def _side(units: DataFrame) -> DataFrame:
    """(volume, ord, part_code, unit_label, k1, k2): an edition with its texts as 128 bits, which are null for empty texts."""
    text = F.nullif(F.col("text"), F.lit(""))
    key = lambda seed: F.when(text.isNotNull(), F.xxhash64(F.lit(seed), text))
    return units.select("volume", "ord", *[F.coalesce(c, F.lit("")).alias(c) for c in ("part_code", "unit_label")], key(1).alias("k1"), key(2).alias("k2"))


def _anchors(a: DataFrame, b: DataFrame) -> DataFrame:
    """(volume, ord_a, ord_b) of the texts that occur once in both editions of a volume."""
    both = a.select("volume", "k1", "k2", F.col("ord").alias("ord_a"), F.lit(None).cast("long").alias("ord_b")).unionByName(b.select("volume", "k1", "k2", F.lit(None).cast("long").alias("ord_a"), F.col("ord").alias("ord_b")))
    n = [F.count(c).alias(f"n_{c}") for c in ("ord_a", "ord_b")]
    return both.where("k1 is not null").groupBy("volume", "k1", "k2").agg(*n, F.min("ord_a").alias("ord_a"), F.min("ord_b").alias("ord_b")).where("n_ord_a = 1 and n_ord_b = 1").select("volume", "ord_a", "ord_b")


def edition_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """R-10: (volume, change, label_a, label_b, ord_a, ord_b) for editions of (volume, part_code, ord, unit_label, text).

    (volume, ord) names a unit and orders a volume; other columns are ignored. A pair is ``unchanged``, ``renumbered`` (the
    text stands in its order under another label), ``moved`` (the text has left its order or its part) or ``changed`` (the
    label has another text); a unit without pair is ``removed`` or ``added``. Null texts and labels are taken as empty, and
    empty texts are no anchors."""
    a, b = written(_side(old)), written(_side(new))
    # Each edition meets the anchors once: what has one goes on to be judged, the rest to the pairing by keys.
    first = written(a.withColumn("ord_a", F.col("ord")).join(_anchors(a, b), ["volume", "ord_a"], "left"))
    left = first.where("ord_b is null").select(*a.columns)
    met = first.where("ord_b is not null").select("volume", "ord_a", "ord_b", F.col("unit_label").alias("label_a"), F.col("part_code").alias("part_a"))
    second = written(b.withColumn("ord_b", F.col("ord")).join(met, ["volume", "ord_b"], "left"))
    right = second.where("ord_a is null").select(*b.columns)
    anchors = _in_order(second.where("ord_a is not null").select("volume", "ord_a", "ord_b", "label_a", F.col("unit_label").alias("label_b"), "part_a", F.col("part_code").alias("part_b")))
    change = F.when(~F.col("in_order"), "moved").when(F.col("label_a") == F.col("label_b"), "unchanged").otherwise("renumbered")
    out = anchors.select(*_PAIR, change.alias("change"))
    # Empty texts are equal texts under one label, and none by themselves.
    some = lambda side: side.where("k1 is not null")
    filled = lambda side: side.na.fill(0, ["k1", "k2"])
    for of, keys, change in ((filled, ["unit_label", "k1", "k2"], "unchanged"), (lambda side: side, ["unit_label"], "changed"), (some, ["k1", "k2"], "renumbered")):
        pairs = written(_paired(of(left), of(right), keys, F.lit(change)))
        out = out.unionByName(pairs)
        left, right = written(_without(left, pairs, "ord_a")), written(_without(right, pairs, "ord_b"))
    alone = lambda side, name, change: side.select("volume", F.lit(change).alias("change"), *[F.col(c).alias(f"{k}_{name}") for c, k in (("unit_label", "label"), ("ord", "ord"))])
    out = out.unionByName(alone(left, "a", "removed"), allowMissingColumns=True).unionByName(alone(right, "b", "added"), allowMissingColumns=True)
    return out.select("volume", "change", "label_a", "label_b", "ord_a", "ord_b")
