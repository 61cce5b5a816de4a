"""N-gram Jaccard join: documents whose sets of n-word shingles are similar, found exactly.

Method: rare-first prefix filtering. All shingles have one order, rarest in the corpus first. Two sets that reach the
similarity share a shingle among the first n - ceil(percent * n / 100) + 1 of each, so only these prefixes are joined,
and of them only shingles that occur at least twice. A pair that meets at a prefix shingle must also pass

- the length filter: the smaller set has at least ``percent`` percent of the larger one's size,
- the positional filter: what is left of both from this shingle on can still reach the overlap that the sizes require,
- the suffix filter: what stands before the shingle in both, and the differences of what follows, counted by BINS
  ranges of the hash, do not pass the number of shingles in which two such sets may differ.

A link passes all three where its first common shingle is, so each bucket can be judged by itself. ``set_links`` then
verifies pairs on the full sets: a pair of leader and member once, and pairs with a bucket's strays in blocks.

Frequencies are counted in parts of the hash space: each bundle of documents sends its distinct shingles once, and what
comes back is a byte for each, 0 for a shingle without a second occurrence and eight steps to the octave above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import answer_parts, bundles_and_parts, cuts_by_part, forget, joined, materialize, pack, planes, read_bundle, requests, unique_keys, unpack
from .set_links import classes, link_buckets, members, one_set, set_digests, shingle_sets

#: Bits of a shingle's hash that travel besides its part: shingles that agree in them share a frequency, which moves
#: them in the order but leaves it one order.
_BITS = 32
BINS = 16
_REPS = -1
_POSTING = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("rest", pa.int64()), ("sig", pa.list_(pa.int16()))])
_POSTING_DDL = "key long, id long, n long, rest long, sig array<smallint>"


class NearSets:
    """Length, positional and suffix filters. Index rows have n, the set's size, rest, how many shingles follow the key,
    and sig, the counts of these by range of the hash; of documents sig counts the whole set."""

    def __init__(self, percent: int):
        self.percent = percent

    def far(self, a: str, b: str) -> Column:
        return F.aggregate(F.zip_with(f"{a}.sig", f"{b}.sig", lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda x, y: x + y)

    def pairs(self, a: str, b: str) -> Column:
        p, c = self.percent, lambda x: F.col(x)
        overlap = F.expr(f"({p} * ({a}.n + {b}.n) + {99 + p}) div {100 + p}")
        before = c(f"{a}.n") - 1 - c(f"{a}.rest") + c(f"{b}.n") - 1 - c(f"{b}.rest")
        length = 100 * F.least(f"{a}.n", f"{b}.n") >= p * F.greatest(f"{a}.n", f"{b}.n")
        return length & (1 + F.least(f"{a}.rest", f"{b}.rest") >= overlap) & (before + self.far(a, b) <= c(f"{a}.n") + c(f"{b}.n") - 2 * overlap)

    def distances(self, s1: np.ndarray, s2: np.ndarray) -> np.ndarray:
        differ = np.zeros((len(s1), len(s2)), dtype=np.int32)
        for k in range(BINS):
            differ += np.abs(s1[:, k, None].astype(np.int32) - s2[None, :, k])
        return differ

    def slack(self, n: np.ndarray) -> np.ndarray:
        """Sets that differ in more shingles than this are not linked with any set of a size that the length filter allows."""
        return n * (100 - self.percent) // self.percent + 1

    def blocks(self, n1: np.ndarray, s1: np.ndarray, n2: np.ndarray, s2: np.ndarray) -> np.ndarray:
        differ = self.distances(s1, s2)
        n1, n2 = n1[:, None], n2[None, :]
        overlap = -(-self.percent * (n1 + n2) // (100 + self.percent))
        return (differ <= n1 + n2 - 2 * overlap) & (100 * np.minimum(n1, n2) >= self.percent * np.maximum(n1, n2))


def _bins(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(BINS - 1)).astype(np.uint8)


def _counts(bins: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.ListArray:
    """How many of ``bins[begin:end]`` are of each kind, for all begins and ends; 32767 stands for more, which keeps
    differences of two counts a lower bound."""
    out = np.empty((len(begin), BINS), dtype=np.int16)
    for k in range(BINS):
        run = np.concatenate([[0], np.cumsum(bins == k)])
        out[:, k] = np.minimum(run[end] - run[begin], 32767)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(begin) + 1) * BINS, pa.int32()), pa.array(out.ravel()))


def _digests(bundles: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, sig, bundle_id): sizes, digests, null for empty sets, and counts by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, texts = read_bundle(r["doc_ids"], r["sizes"], r["texts"])
                keys, cut = shingle_sets(texts, words)
                n = np.diff(cut)
                cols = [pa.array(ids), pa.array(n), *[pa.array(d, mask=n == 0) for d in set_digests(keys, cut)], _counts(_bins(keys), cut[:-1], cut[1:]), pa.array(np.full(len(ids), r["bundle_id"]))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "s1", "s2", "sig", "bundle_id"])

    return bundles.select("bundle_id", "doc_ids", "sizes", "texts").mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long, sig array<smallint>, bundle_id long")


def _rarity(bundles: DataFrame, words: int, parts: int) -> DataFrame:
    """For each bundle and part, a byte for each distinct shingle of the bundle: how often it occurs in the corpus.
    Equal sets of a bundle count once."""

    def ask(ids: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        keys, cut = shingle_sets(texts, words)
        first = np.zeros(len(texts), dtype=bool)
        first[np.unique(np.stack(set_digests(keys, cut), axis=1), axis=0, return_index=True)[1]] = True
        tails, inverse, part = unique_keys(keys, parts, _BITS)
        n = np.bincount(inverse[np.repeat(first, np.diff(cut))], minlength=len(tails)).astype(np.uint32)
        for p, a, b in cuts_by_part(part):
            yield p, pack(*planes(tails[a:b], _BITS // 8), n[a:b])

    def answer(bundle_ids: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        rows = [(joined(b[:-1]), b[-1]) for b in map(unpack, blobs)]
        unique, inverse = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
        n = np.bincount(inverse, weights=np.concatenate([r[1] for r in rows]), minlength=len(unique))
        rarity = np.minimum(8 * np.log2(np.maximum(n, 1)), 255).astype(np.uint8)[inverse]
        for b, x in zip(bundle_ids, np.split(rarity, np.cumsum([len(r[0]) for r in rows])[:-1])):
            yield b, pack(x)

    return answer_parts(requests(bundles, ask), answer)


def _postings(bundles: DataFrame, rarity: DataFrame, reps: DataFrame, words: int, percent: int, parts: int) -> DataFrame:
    """(key, id, n, rest, sig): the prefix shingles of each representative that occur again."""

    def some(table: pa.Table) -> pa.Table:
        blob = pack(table.column("id").to_numpy(), table.column("s1").to_numpy())
        return pa.table([table.column("bundle_id").slice(0, 1), pa.array([_REPS], pa.int32()), pa.array([blob], pa.binary())], names=["bundle_id", "part", "blob"])

    speak = reps.select("bundle_id", "id", "s1").groupBy("bundle_id").applyInArrow(some, "bundle_id long, part int, blob binary")

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        got = dict(zip(right.column("part").to_pylist(), right.column("blob").to_pylist()))
        out = []
        for r in left.to_pylist() if _REPS in got else []:
            ids, texts = read_bundle(r["doc_ids"], r["sizes"], r["texts"])
            keys, cut = shingle_sets(texts, words)
            chosen = set(zip(*(x.tolist() for x in unpack(got[_REPS]))))
            mine = np.array([pair in chosen for pair in zip(ids.tolist(), set_digests(keys, cut)[0].tolist())], dtype=bool)
            rare = np.concatenate([np.zeros(0, np.uint8), *[unpack(got[p])[0] for p in sorted(got) if p != _REPS]])[unique_keys(keys, parts, _BITS)[1]]
            n = np.diff(cut)
            owner = np.repeat(np.arange(len(ids)), n)
            order = np.lexsort((keys, rare, owner))
            keys, rare = keys[order], rare[order]
            place = np.arange(len(keys)) - cut[owner]
            at = np.flatnonzero(mine[owner] & (rare > 0) & (place <= (n + -percent * n // 100)[owner]))
            who = owner[at]
            cols = [keys[at].view(np.int64), ids[who], n[who], (n[who] - 1 - place[at]), _counts(_bins(keys), at + 1, cut[who + 1])]
            out.append(pa.table([pa.array(c) for c in cols], schema=_POSTING))
        return pa.concat_tables(out) if out else _POSTING.empty_table()

    asked = rarity.unionByName(speak)
    return bundles.groupBy("bundle_id").cogroup(asked.groupBy("bundle_id")).applyInArrow(send, _POSTING_DDL)


def jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id), a row per document.

    n_shingles is the size of the document's set of distinct ``words``-word shingles, A-Z lower-cased; with fewer
    words the whole sequence is the one shingle; a null, empty or blank text has no shingles and no links. Two documents
    are linked if 100 * intersection >= percent * union. class_id is the least id with an equal set, component_id the
    least id reachable over links, its own included. Other columns are ignored. Rows that repeat a doc_id are one document,
    with the set of the row of least digest, a set without shingles last. An empty table gives no rows. Memory follows
    the longest text.
    """
    bundles, parts = bundles_and_parts(docs)
    raw = materialize(_digests(bundles, words))
    sig = materialize(one_set(raw, "n_shingles", "s1", "s2", "sig", "bundle_id"))
    forget(raw)
    reps = materialize(classes(sig).join(sig.select(F.col("doc_id").alias("id"), "bundle_id"), "id"))
    rarity = materialize(_rarity(bundles, words, parts))
    postings = materialize(_postings(bundles, rarity, reps, words, percent, parts))
    forget(bundles, rarity)
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    index = materialize(postings.join(shared, "key"))
    forget(postings)
    part = link_buckets(index, reps, docs, words, percent, NearSets(percent))
    forget(index)
    return members(sig, reps, part)
