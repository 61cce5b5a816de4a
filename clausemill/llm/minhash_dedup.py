"""MinHash near-dedup with exact confirmation.

Method: multi-index Hamming join. A document's signature is CHUNKS * CHUNK symbols of b = 16 bits, each the low bits
of the least hash of its shingles under one hash function. Two signatures at a distance of at most
CHUNKS * (ERRORS + 1) - 1 symbols must, by pigeonhole, agree in some chunk but for at most ERRORS symbols; each chunk
enumerates the allowed errors by leaving out that many symbols in every way, and the remaining symbols are the index
key. So every pair within the signature distance shares a key. With 8 chunks of 4 symbols and 1 error the distance is
15 of 32; two sets of similarity 0.8 exceed it with probability 7e-5, more similar ones more rarely.

``set_links`` finds the links among documents that share a key, confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, materialize, mix64, pick
from .set_links import classes, link_buckets, members, one_set, set_digests, shingle_sets, text_slices

CHUNKS, CHUNK, ERRORS = 8, 4, 1
SYMBOLS = CHUNKS * CHUNK
DISTANCE = CHUNKS * (ERRORS + 1) - 1
_SEEDS = mix64(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_KEPT = list(combinations(range(CHUNK), CHUNK - ERRORS))


def _signatures(keys: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """A row of SYMBOLS 16-bit symbols for each non-empty set."""
    starts = cut[:-1][np.diff(cut) > 0]
    out = np.zeros((len(starts), SYMBOLS), dtype=np.uint16)
    for k in range(SYMBOLS if len(starts) else 0):
        h = (keys ^ (keys >> np.uint64(31))) * _SEEDS[k]
        least = np.minimum.reduceat(h ^ (h >> np.uint64(29)), starts)
        out[:, k] = (mix64(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, sig): set size, a 128-bit digest of the set, null for an empty one, and the
    signature, an array of symbols, empty for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, texts in text_slices(b):
                keys, cut = shingle_sets(texts, words)
                n = np.diff(cut)
                some = n > 0
                symbols = pa.array(_signatures(keys, cut).view(np.int16).ravel())
                sigs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * SYMBOLS)]), pa.int32()), symbols)
                cols = [rows.column(0), pa.array(n.astype(np.int64)), *[pa.array(d, mask=~some) for d in set_digests(keys, cut)], sigs]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "s1", "s2", "sig"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long, sig array<smallint>")


def _keys(sig: str) -> Column:
    """Every chunk of a signature without ERRORS of its symbols, in every way, each hashed with which way it is."""
    ways = [(c * len(_KEPT) + k, [CHUNK * c + i for i in kept]) for c in range(CHUNKS) for k, kept in enumerate(_KEPT)]
    return F.array(*[F.xxhash64(F.lit(way), *[F.get(sig, F.lit(i)) for i in symbols]) for way, symbols in ways])


class NearSignatures:
    """Pairs that the set sizes and the signature distance do not rule out."""

    def __init__(self, percent: int):
        self.percent = percent

    def far(self, a: str, b: str) -> Column:
        """Symbols in which two signatures differ."""
        return F.size(F.filter(F.zip_with(f"{a}.sig", f"{b}.sig", lambda x, y: x != y), lambda differ: differ))

    def pairs(self, a: str, b: str) -> Column:
        return (100 * F.least(f"{a}.n", f"{b}.n") >= self.percent * F.greatest(f"{a}.n", f"{b}.n")) & (self.far(a, b) <= DISTANCE)

    def distances(self, s1: np.ndarray, s2: np.ndarray) -> np.ndarray:
        differ = np.zeros((len(s1), len(s2)), dtype=np.uint8)
        for k in range(SYMBOLS):
            differ += s1[:, k, None] != s2[None, :, k]
        return differ

    def slack(self, n: np.ndarray) -> np.ndarray:
        return np.full(len(n), DISTANCE)

    def blocks(self, n1: np.ndarray, s1: np.ndarray, n2: np.ndarray, s2: np.ndarray) -> np.ndarray:
        return (self.distances(s1, s2) <= DISTANCE) & (100 * np.minimum(n1[:, None], n2[None, :]) >= self.percent * np.maximum(n1[:, None], n2[None, :]))


def _buckets(reps: DataFrame) -> DataFrame:
    """(key, size, id, n, sig): index rows whose key occurs more than once. Most keys do not, and go by key and id
    alone; set sizes and signatures join those that are left."""
    index = reps.select(F.explode(_keys("sig")).alias("key"), "id")
    shared = index.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return index.join(shared, "key").join(reps.select("id", "n", "sig"), "id")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id, kept), a row per document.

    n_shingles is the size of the document's set of distinct ``words``-word shingles, A-Z lower-cased; with fewer
    words the whole sequence is the one shingle; a null, empty or blank text has no shingles and no links. Documents
    are linked if 100 * intersection >= percent * union. class_id is the least id with an equal set, component_id the
    least id reachable over links, kept whether that is the document's own. Other columns are ignored. Rows that repeat
    a doc_id are one document, with the set of the row of least digest, a set without shingles last. An empty table gives
    no rows.
    """
    raw = materialize(signatures(docs, words))
    sig = materialize(one_set(raw, "n_shingles", "s1", "s2", "sig"))
    forget(raw)
    reps = materialize(classes(sig))
    index = materialize(_buckets(reps.select("id", "n", "sig")))
    part = link_buckets(index, reps, docs, words, percent, NearSignatures(percent))
    forget(index)
    return members(sig, reps, part).withColumn("kept", F.col("doc_id") == F.col("component_id"))
