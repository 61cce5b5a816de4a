"""Links between shingle sets that share a key, confirmed on the full sets, without listing the pairs of a bucket.

Documents with equal shingle sets form classes first, and classes are joined by representatives. An index gives each
representative some keys; those that share one form a bucket, and a *near* rule says which pairs of sizes and sketches
can be links at all. Within a bucket no list of all pairs is made:

1. Each member is paired with one leader, the nearest among its buckets' leaders that the rule allows. A bucket's leader
   is the member whose keys are shared most: of near copies, the one closest to their common source. Confirmed links make
   trees of leaders, whose parts are connected for sure, and a bucket's main component is the largest part in it.
2. Members outside a bucket's main component are its strays. A stray is compared with the leaders of that component, and
   by the triangle inequality only with those of a leader's members that are far enough from it: a sketch that is farther
   from the leader than a link allows can only be near to members that are far from the leader too. Strays of one main
   component are compared with each other. All this goes in blocks: first sizes and sketches, and where some pass, the
   full sets, whose intersections are one matrix product. A block puts out a forest of its links, never its pairs.

Every pair that shares a key and that the rule allows is then linked, unlinked by comparison, or inside one component
already.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, forget, materialize, mix64, pick, window_hashes
from .components import connected_components


class Near(Protocol):
    """Which pairs can be links; must hold for every link that the index promises to find."""

    def pairs(self, a: str, b: str) -> Column:
        """By two index rows, structs ``a`` and ``b``."""

    def far(self, a: str, b: str) -> Column:
        """How far apart two index rows are, to choose the nearest leader."""

    def distances(self, s1: np.ndarray, s2: np.ndarray) -> np.ndarray:
        """How far apart the sketches of two blocks are: a matrix. A metric, and what ``far`` gives for documents."""

    def slack(self, n: np.ndarray) -> np.ndarray:
        """How far apart the sketches of a set of this size and of one that it is linked with can be."""

    def blocks(self, n1: np.ndarray, s1: np.ndarray, n2: np.ndarray, s2: np.ndarray) -> np.ndarray:
        """By sizes and sketches of two blocks of documents: a matrix."""


# ---------------------------------------------------------------- sets


def text_slices(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows whose last column is a text, as stretches of about ``size`` bytes: the rows and their texts, null ones empty."""
    texts = [x or b"" for x in batch.column(batch.num_columns - 1).cast(pa.large_binary()).to_pylist()]
    start, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size or i == len(texts) - 1:
            yield batch.slice(start, i + 1 - start), texts[start : i + 1]
            start, total = i + 1, 0
    # Workers outlive their stage: what Arrow has in hand goes back.
    pa.default_memory_pool().release_unused()


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of all texts in a row, and where each text's begin (one more at the end).
    A text with fewer words than a shingle has its whole sequence as the one shingle; without words it has none."""
    w = Words(texts, lower=True)
    counts, first = w.counts, w.first
    n = len(w.hash)
    at = np.arange(max(0, n - words + 1))
    owner = w.owner()
    whole = owner[at] == owner[at + words - 1] if len(at) else np.zeros(0, bool)
    keys, own = window_hashes(w.hash, words)[whole], owner[at][whole]
    short = np.flatnonzero((counts > 0) & (counts < words))
    extra = [mix64(np.uint64(int(counts[i])) + window_hashes(w.hash[first[i] : first[i + 1]], int(counts[i]))) for i in short]
    if len(short):
        keys, own = np.concatenate([keys, *extra]), np.concatenate([own, short])
    order = np.lexsort((keys, own))
    keys, own = keys[order], own[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])
    keys, own = keys[new], own[new]
    return keys, np.searchsorted(own, np.arange(len(texts) + 1))


def set_digests(keys: np.ndarray, cut: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit digests of each set, zero for an empty one."""
    some = np.diff(cut) > 0
    out = [np.zeros(len(some), dtype=np.int64) for _ in range(2)]
    for d, seed in zip(out, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
        if some.any():
            d[some] = np.add.reduceat(mix64(keys ^ np.uint64(seed)), cut[:-1][some]).view(np.int64)
    return out


def one_set(sig: DataFrame, *columns: str) -> DataFrame:
    """One row per doc_id: of rows that repeat one, that of the least digest; empty sets come last."""
    order = F.struct(F.col("s1").isNull(), "s1", "s2")
    row = F.min_by(F.struct(*columns), order).alias("row")
    return sig.groupBy("doc_id").agg(row).select("doc_id", "row.*")


def classes(sig: DataFrame) -> DataFrame:
    """(s1, s2, id, n, sig): each different set by the least doc_id that has it."""
    some = sig.where("n_shingles > 0")
    return some.groupBy("s1", "s2").agg(F.min("doc_id").alias("id"), F.min("n_shingles").alias("n"), F.min_by("sig", "doc_id").alias("sig"))


def shingle_table(docs: DataFrame, reps: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles): the full sets of the documents in ``ids`` (id), made again from their texts. Of rows that repeat
    an id only those count whose set has the representative's digest."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, texts in text_slices(b):
                keys, cut = shingle_sets(texts, words)
                mine = set_digests(keys, cut)[0] == rows.column(1).to_numpy()
                raw, at = keys.tobytes(), (cut * 8).tolist()
                out = pa.RecordBatch.from_arrays([rows.column(0), pa.array([raw[x:y] for x, y in zip(at, at[1:])], pa.binary())], ["doc_id", "shingles"])
                yield out.filter(pa.array(mine))

    wanted = reps.select("id", "s1").join(ids, "id", "left_semi").select(F.col("id").alias("doc_id"), "s1").hint("merge")
    rows = pick(docs, "doc_id", "text").join(wanted, "doc_id").select("doc_id", "s1", "text")
    return materialize(rows.mapInArrow(sets, "doc_id long, shingles binary"))


_TOGETHER = 1024


def confirm(pairs: DataFrame, reps: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of document ids whose full shingle sets have 100 * intersection >= percent * union, written.
    Pairs are grouped by a and a hash of b, about _TOGETHER of them, so that a set that many others are compared with
    goes to as many tasks as it has work for, once to each."""
    have = shingle_table(docs, reps, pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), words)

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        one = {d: np.frombuffer(s, np.uint64) for d, s in zip(left.column("one").to_pylist(), left.column("one_set").to_pylist())}
        rows = []
        for a, b, s in zip(right.column("a").to_pylist(), right.column("b").to_pylist(), right.column("other_set")):
            x, y = one[a], np.frombuffer(s.as_py(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                rows.append((a, b))
        a, b = zip(*rows) if rows else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / _TOGETHER).alias("blocks"))
    blocks = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), "blocks").cast("int").alias("block"))
    left = blocks.select(F.col("a").alias("one"), F.col("block").alias("one_block")).distinct().join(have, F.col("one") == F.col("doc_id"))
    left = left.select("one", "one_block", F.col("shingles").alias("one_set"))
    right = blocks.join(have, F.col("b") == F.col("doc_id")).select("a", "b", "block", F.col("shingles").alias("other_set"))
    out = materialize(left.groupBy("one", "one_block").cogroup(right.groupBy("a", "block")).applyInArrow(check, "a long, b long"))
    forget(have)
    return out


# ---------------------------------------------------------------- buckets


def _leader_pairs(index: DataFrame, near: Near) -> DataFrame:
    """One pair (a, b) of a leader and each member of any of its buckets, see 1."""
    rank = F.struct("shared", -F.col("id"))
    row = F.struct(*[c for c in index.columns if c not in ("key", "size")])
    ranked = index.join(index.groupBy("id").agg(F.sum("size").alias("shared")), "id")
    lead = ranked.groupBy("key").agg(F.max_by(row, rank).alias("b"))
    met = index.select("key", row.alias("a")).join(lead, "key").where((F.col("a.id") != F.col("b.id")) & near.pairs("a", "b"))
    far = F.struct(near.far("a", "b").alias("far"), F.col("b.id").alias("id"))
    return met.groupBy(F.col("a.id").alias("b")).agg(F.min(far).alias("x")).select(F.col("x.id").alias("a"), "b")


def _trees(links: DataFrame) -> DataFrame:
    """(id, component_id): each document of confirmed leader links (a, b) with its leaders' leader, eight steps up,
    written. A leader is shared more than its members, so links have no circles. Longer chains fall into several parts,
    which is enough here: the last step joins them."""
    up = materialize(links.select(F.col("b").alias("id"), F.col("a").alias("up")))
    for _ in range(3):
        more = up.select(F.col("id").alias("up"), F.col("up").alias("more"))
        old, up = up, materialize(up.join(more, "up", "left").select("id", F.coalesce("more", "up").alias("up")))
        forget(old)
    tops = up.select(F.col("up").alias("id")).distinct().join(up.select("id"), "id", "left_anti")
    out = materialize(up.select("id", F.col("up").alias("component_id")).unionByName(tops.withColumn("component_id", F.col("id"))))
    forget(up)
    return out


def _strays(index: DataFrame, part: DataFrame) -> DataFrame:
    """(main, id, c): the documents outside the main component of a bucket with several, and their own component."""
    own = index.select("key", "id").join(part.hint("merge"), "id", "left").select("key", "id", F.coalesce("component_id", "id").alias("c"))
    sizes = own.groupBy("key", "c").agg(F.count(F.lit(1)).alias("in_bucket"))
    main = sizes.groupBy("key").agg(F.max_by("c", F.struct("in_bucket", "c")).alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("key", "main")
    return own.join(main, "key").where("c != main").select("main", "id", "c").distinct()


_BLOCK = 256
_FOUND = "g long, x int, y int, id long, c long, asked boolean"
_EMPTY = pa.table({"g": pa.array([], pa.int64()), "x": pa.array([], pa.int32()), "y": pa.array([], pa.int32()), "id": pa.array([], pa.int64()), "c": pa.array([], pa.int64()), "asked": pa.array([], pa.bool_())})
_SIDE = ["g", "id", "c", "n", "sig"]


def _sketches(table: pa.Table) -> np.ndarray:
    return table.column("sig").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)


def _in_blocks(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides (g, ...) with x and y: each group's rows in blocks of about _BLOCK, each block once for every block of the
    other side."""
    blocks = lambda df, name: df.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias(name))
    sizes = blocks(left, "xs").join(blocks(right, "ys"), "g")
    dealt = lambda df, own, other: df.join(sizes, "g").withColumns({own[0]: F.pmod(F.xxhash64("id"), F.col(own)).cast("int"), other[0]: F.explode(F.sequence(F.lit(0), F.col(other) - 1))}).drop("xs", "ys")
    return dealt(left, "xs", "ys"), dealt(right, "ys", "xs")


def _bin(distance: Column) -> Column:
    """Distances by powers of two."""
    return F.floor(F.log2(F.greatest(distance, F.lit(0)) + 1)).cast("int")


def _probes(strays: DataFrame, stars: DataFrame, near: Near) -> DataFrame:
    """(leader, id, need): the leaders of a stray's main component that can have members near to it, and how far these must
    be from the leader at least."""
    schema = pa.schema([("leader", pa.int64()), ("id", pa.int64()), ("need", pa.int32())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        need = near.distances(_sketches(left), _sketches(right)).astype(np.int64) - near.slack(left.column("n").to_numpy())[:, None]
        one, two = np.nonzero(need <= right.column("radius").to_numpy()[None, :])
        return pa.table([right.column("id").take(pa.array(two)), left.column("id").take(pa.array(one)), pa.array(np.maximum(need[one, two], 0).astype(np.int32))], schema=schema)

    left, right = _in_blocks(strays.withColumnRenamed("main", "g"), stars.withColumnsRenamed({"main": "g", "leader": "id"}))
    return left.groupBy("g", "x", "y").cogroup(right.groupBy("g", "x", "y")).applyInArrow(run, "leader long, id long, need int")


def _stray_links(strays: DataFrame, part: DataFrame, links: DataFrame, reps: DataFrame, docs: DataFrame, words: int, percent: int, near: Near) -> DataFrame:
    """Links of 2, as a forest (a, b) within each block: documents of one component, by links found there. Written."""
    mains = strays.select("main").distinct()
    sketches = reps.select("id", F.col("n").cast("long").alias("n"), "sig")
    strays = materialize(strays.join(sketches, "id").select("main", "id", "c", "n", "sig"))
    # A document without links is its own component, and one without leader its own leader.
    members = part.select(F.col("component_id").alias("main"), "id").join(mains, "main", "left_semi").unionByName(mains.select("main", F.col("main").alias("id"))).distinct()
    led = members.join(links.select(F.col("b").alias("id"), F.col("a").alias("leader")), "id", "left").withColumn("leader", F.coalesce("leader", "id"))
    row = F.struct("id", "n", "sig")
    placed = led.join(sketches.select("id", row.alias("a")), "id").join(sketches.select(F.col("id").alias("leader"), row.alias("b")), "leader")
    members = materialize(placed.select("main", "leader", "id", F.col("a.n").alias("n"), F.col("a.sig").alias("sig"), near.far("a", "b").alias("far")))
    stars = members.groupBy("main", "leader").agg(F.max("far").alias("radius")).join(sketches.withColumnRenamed("id", "leader"), "leader").select("main", "leader", "n", "sig", "radius")
    probes = _probes(strays, stars, near).join(members.groupBy("leader").agg(F.max("far").alias("radius")), "leader")
    star = lambda k: F.xxhash64("leader", k)
    probes = probes.select("leader", "id", F.explode(F.sequence(_bin(F.col("need")), _bin(F.col("radius")))).alias("bin")).select(star("bin").alias("g"), "id").distinct()
    own = strays.select("id", "c", "n", "sig").dropDuplicates(["id"])
    among = strays.select(F.xxhash64("main", F.lit(-1)).alias("g"), "id", "c", "n", "sig")
    asked = materialize(probes.join(own, "id").select(*_SIDE).unionByName(among))
    others = materialize(members.select(star(_bin(F.col("far"))).alias("g"), "id", F.col("main").alias("c"), "n", "sig").unionByName(among))
    forget(strays, members)

    def sketch(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            (c1, n1), (c2, n2) = ([t.column(k).to_numpy() for k in ("c", "n")] for t in (left, right))
            met = near.blocks(n1, _sketches(left), n2, _sketches(right)) & (c1[:, None] != c2[None, :])
            for t, first in ((left, True), (right, False)):
                some = t.select(["g", "x", "y", "id", "c"]).filter(pa.array(met.any(axis=1 if first else 0)))
                out.append(some.append_column("asked", pa.array([first] * some.num_rows, pa.bool_())))
        return pa.concat_tables(out) if out else _EMPTY

    left, right = _in_blocks(asked, others)
    found = materialize(left.groupBy("g", "x", "y").cogroup(right.groupBy("g", "x", "y")).applyInArrow(sketch, _FOUND))
    forget(asked, others)
    have = shingle_table(docs, reps, found.select("id").distinct(), words)
    sets = found.join(have, F.col("id") == F.col("doc_id")).select("g", "x", "y", "id", "c", "asked", "shingles")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        (i1, c1, s1), (i2, c2, s2) = ([*(t.column(k).to_numpy() for k in ("id", "c")), [np.frombuffer(x.as_py(), np.uint64) for x in t.column("shingles")]] for t in (left, right))
        a: list = []
        b: list = []
        if len(i1) and len(i2):
            n1, n2 = (np.array([len(x) for x in s], dtype=np.int64) for s in (s1, s2))
            both = _intersections(s1, s2)
            a, b = _forest(i1, i2, (100 * both >= percent * (n1[:, None] + n2[None, :] - both)) & (c1[:, None] != c2[None, :]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    other = sets.where("not asked").select(*[F.col(k).alias(f"{k}_2") for k in ("g", "x", "y")], *[F.expr(f"{k} {k}") for k in ("id", "c", "shingles")])
    out = materialize(sets.where("asked").groupBy("g", "x", "y").cogroup(other.groupBy("g_2", "x_2", "y_2")).applyInArrow(compare, "a long, b long"))
    forget(found, have)
    return out


def _forest(left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked id and the first id that the links of this matrix lead it to."""
    n = len(left)
    one, two = np.arange(n), n + np.arange(len(right))
    none = n + len(right)
    while True:
        # Right nodes first: they take labels from the left ones, which are less.
        two = np.minimum(two, np.where(linked, one[:, None], none).min(axis=0))
        more = np.minimum(one, np.where(linked, two[None, :], none).min(axis=1))
        if (more == one).all():
            break
        one = more
    ids, root = np.concatenate([left, right]), np.concatenate([one, two])
    moved = ids != ids[root]
    return ids[moved], ids[root][moved]


def _intersections(xs: list[np.ndarray], ys: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all xs with all ys: products of 0/1 matrices over the shingles that both have."""
    flat = [np.concatenate(s) for s in (xs, ys)]
    owner = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (xs, ys)]
    shared = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    out = np.zeros((len(xs), len(ys)), dtype=np.float32)
    for k in range(0, len(shared), width):
        some = shared[k : k + width]
        sides = []
        for f, o, s in zip(flat, owner, (xs, ys)):
            at = np.searchsorted(some, f)
            hit = at < len(some)
            hit[hit] = some[at[hit]] == f[hit]
            m = np.zeros((len(s), len(some)), dtype=np.float32)
            m[o[hit], at[hit]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def link_buckets(index: DataFrame, reps: DataFrame, docs: DataFrame, words: int, percent: int, near: Near) -> DataFrame:
    """(id, component_id) of the documents with links, written: ``index`` has key, id and what the rule reads, and only
    keys that several have; ``reps`` has id, s1, n and sig."""
    pairs = materialize(_leader_pairs(index, near))
    links = confirm(pairs, reps, docs, words, percent)
    forget(pairs)
    part = _trees(links)
    strays = materialize(_strays(index, part))
    edges = [part.select(F.col("id").alias("a"), F.col("component_id").alias("b")), links]
    if not strays.isEmpty():
        edges.append(_stray_links(strays, part, links, reps, docs, words, percent, near))
    out = connected_components(reduce(DataFrame.unionByName, edges))
    forget(strays, part, *edges[1:])
    return out


def members(sig: DataFrame, reps: DataFrame, part: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) from the documents' digests, the classes and their components."""
    member = sig.join(reps.select("s1", "s2", F.col("id").alias("class_id")), ["s1", "s2"], "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    joined = member.join(part.select(F.col("id").alias("class_id"), "component_id"), "class_id", "left")
    return joined.select("doc_id", "n_shingles", "class_id", F.coalesce("component_id", "class_id").alias("component_id"))
