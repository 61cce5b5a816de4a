"""Nearest vectors by cosine over an index of lists, exact by bounds.

Every vector is in the list of its nearest centroid, as a unit vector, with its norm. Centroids are fitted on at most
SAMPLE_ROWS vectors, chosen by a hash of their ids; they decide how much is read, never what is found. A list's radius is the
distance of its farthest member, so no member is nearer to a query than the centroid's distance less the radius. A search
reads the nearest lists first, and then only lists that can still hold one of the best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.sources.files import written

SAMPLE_ROWS = 20_000
MAX_LISTS = 1024
#: Vectors of a list that one task compares at once.
BLOCK = 8192
#: Scores are compared at six digits; bounds leave room for rounding.
DIGITS, MARGIN = 6, 2e-6


@dataclass
class VectorIndex:
    """``rows``: (vec_id, label, weight, norm, unit, list); ``lists``: (list, radius, n); centroids, one per list."""

    rows: DataFrame
    lists: DataFrame
    centroids: np.ndarray


def _unit(vector: str) -> tuple[Column, Column]:
    """A vector's norm and its unit vector, null without direction."""
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & (norm > 0)
    return F.when(fine, norm), F.when(fine, F.transform(v, lambda x: x / norm))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)[None, :] - 2 * x @ centroids.T
    return np.sqrt(np.maximum(squares, 0))


def build_index(vectors: DataFrame, lists: int | None = None) -> VectorIndex:
    """The index of ``vectors`` (vec_id, embedding, label, weight), written to the scratch folder. Vectors that are null, zero
    or not finite have no direction and are not in it; vectors of one table have one length. Without ``lists`` there are
    about as many as the root of the number of vectors, at most MAX_LISTS."""
    norm, unit = _unit("embedding")
    rows = written(vectors.select("vec_id", "label", "weight", norm.alias("norm"), unit.alias("unit")).where("unit is not null"))
    n = rows.count()
    if not n:
        empty = rows.withColumn("list", F.lit(0))
        return VectorIndex(empty, empty.select("list", F.lit(0.0).alias("radius"), F.lit(0).cast("long").alias("n")).limit(0), np.zeros((0, 0)))
    k = min(lists or max(1, min(MAX_LISTS, isqrt(n))), n)
    sample = rows if n <= SAMPLE_ROWS else rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) < SAMPLE_ROWS)
    d = rows.select(F.size("unit")).first()[0]
    centroids = np.zeros((1, d))
    if k > 1:
        model = KMeans(k=k, seed=1, maxIter=8, initSteps=1).fit(sample.select(array_to_vector("unit").alias("features")))
        centroids = np.array([list(c) for c in model.clusterCenters()])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = _distances(_matrix(b.column("unit"), d), centroids)
            own = far.argmin(axis=1).astype(np.int32)
            yield b.append_column("list", pa.array(own)).append_column("far", pa.array(far[np.arange(len(own)), own]))

    placed = written(rows.mapInArrow(place, ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", list int, far double").repartitionByRange("list", "vec_id").sortWithinPartitions("list"))
    radii = placed.groupBy("list").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n"))
    return VectorIndex(placed.drop("far"), written(radii), centroids)


def _plan(index: VectorIndex, queries: DataFrame) -> DataFrame:
    """(qid, unit, list, best, n, nth, before): for each query and list the best cosine that a member can have, the list's
    place by distance and the members of nearer lists. As many rows as queries times lists, which are bounded."""
    centroids = index.centroids
    known = {r["list"]: (r["radius"], r["n"]) for r in index.lists.collect()}  # a row per list
    k = len(centroids)
    radius, size = (np.array([known.get(i, (0.0, 0))[j] for i in range(k)]) for j in (0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = _distances(_matrix(b.column(1), centroids.shape[1]), centroids)
            least = np.maximum(far - radius, 0)
            order = np.argsort(far, axis=1, kind="stable")
            n = size[order]
            own = pa.array(np.repeat(np.arange(b.num_rows), k))
            flat = lambda x: np.take_along_axis(x, order, axis=1).ravel()
            cols = [b.column(0).take(own), b.column(1).take(own), pa.array(order.ravel().astype(np.int32)), pa.array(flat(1 - least**2 / 2)), pa.array(n.ravel().astype(np.int64)), pa.array(np.tile(np.arange(k, dtype=np.int32), b.num_rows)), pa.array((np.cumsum(n, axis=1) - n).ravel().astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, ["qid", "unit", "list", "best", "n", "nth", "before"])

    return queries.mapInArrow(run, "qid long, unit array<double>, list int, best double, n long, nth int, before long").where("n > 0")


def _read(index: VectorIndex, probes: DataFrame, first: int) -> DataFrame:
    """(qid, vec_id, label, weight, score): of each probe (qid, unit, list) the ``first`` nearest of each block of the list.
    Lists are joined by number; long ones in blocks, each with all the queries that read the list."""
    d = index.centroids.shape[1]
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    sizes = index.lists.select("list", blocks.alias("blocks"))
    members = index.rows.join(F.broadcast(sizes), "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")).drop("blocks")
    asked = probes.select("qid", "unit", F.col("list").alias("asked"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("asked_block"))
    schema = pa.schema([("qid", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int32()), ("weight", pa.int32()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        left = left.sort_by("vec_id")
        x = _matrix(left.column("unit").combine_chunks(), d)
        out = []
        for at in range(0, right.num_rows, 1024):
            part = right.slice(at, 1024)
            score = np.round(_matrix(part.column("unit").combine_chunks(), d) @ x.T, DIGITS) + 0.0
            best = np.argsort(-score, axis=1, kind="stable")[:, :first]
            own, at_x = pa.array(np.repeat(np.arange(len(score)), best.shape[1])), pa.array(best.ravel())
            cols = [part.column("qid").take(own), *(left.column(c).take(at_x) for c in ("vec_id", "label", "weight")), pa.array(np.take_along_axis(score, best, axis=1).ravel())]
            out.append(pa.table(cols, schema=schema))
        return pa.concat_tables(out)

    return members.groupBy("list", "block").cogroup(asked.groupBy("asked", "asked_block")).applyInArrow(run, "qid long, vec_id long, label int, weight int, score double")


def _top(scored: DataFrame, k: int, name: str, by: str = "score") -> DataFrame:
    order = Window.partitionBy("qid").orderBy(F.desc(by), "vec_id")
    return scored.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def nearest(index: VectorIndex, queries: DataFrame, first: int = 20, lists: int = 2) -> DataFrame:
    """(qid, vec_id, label, weight, score, nth): of each query (qid, query) the ``first`` nearest vectors by cosine at six
    digits, ties by vec_id; all there are if they are fewer. A query without direction finds nothing. At least the nearest
    ``lists`` lists, and as many as hold ``first`` vectors, are read first."""
    if not len(index.centroids):
        return queries.sparkSession.createDataFrame([], "qid long, vec_id long, label int, weight int, score double, nth int")
    asked = queries.select(F.col("qid").cast("long").alias("qid"), _unit("query")[1].alias("unit")).where("unit is not null")
    plan = written(_plan(index, asked))
    soon = (F.col("nth") < lists) | (F.col("before") < first)
    near = written(_top(_read(index, plan.where(soon), first), first, "nth"))
    last = near.groupBy("qid").agg(F.min("score").alias("last"), F.count(F.lit(1)).alias("found"))
    more = plan.where(~soon).join(last, "qid").where((F.col("found") < first) | (F.col("best") + MARGIN >= F.col("last")))
    return _top(near.drop("nth").unionByName(_read(index, more.select("qid", "unit", "list", "n"), first)), first, "nth")


def semantic_search(index: VectorIndex, queries: DataFrame, labels: list[int], first: int = 20, k: int = 5, boost: float = 0.0) -> DataFrame:
    """R-8: (qid, vec_id, score, weight, place): of each query the ``first`` nearest vectors, of these the ones with a label
    asked for, and the k best by score and weight: score + boost * weight, at six digits, ties by vec_id. With a boost of 0
    the weight is without effect; how much it counts for is ours."""
    kept = nearest(index, queries, first).where(F.col("label").isin(labels)).withColumn("relevance", F.round(F.col("score") + boost * F.col("weight"), DIGITS))
    return _top(kept, k, "place", "relevance").select("qid", "vec_id", "score", "weight", "place")
