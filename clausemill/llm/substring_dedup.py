"""Substring dedup: remove long word sequences that an earlier document holds.

Method: fixed-block anchors. Every document's non-overlapping blocks of BLOCK words are the index; every rolling window
of BLOCK words probes it. A repeated stretch of at least 2 * BLOCK words holds a whole block of the document it repeats,
wherever that document's blocks begin, so it is probed by the window at the same words. Hits are extended: all
windows of the full length that hold a hit are compared by a 128-bit hash with those of all other documents, and runs of
confirmed windows are the maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE_B, REQUEST, REQUEST_ARROW, Words, answer_parts, bundles_and_parts, cuts_by_part, forget, joined, materialize, meet, pack, part_of, planes, requests, unique_keys, unpack, window_hashes

_BITS = 32


def _probes(w: Words, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows of ``block`` words within a text, their hashes, and whether a block of the text starts
    there."""
    n = len(w.hash) - block + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    owner = w.owner()
    at = np.flatnonzero(owner[:n] == owner[block - 1 :])
    return at, window_hashes(w.hash, block)[at], (at - w.first[owner[at]]) % block == 0


def _windows(w: Words, hits: np.ndarray, length: int, block: int) -> np.ndarray:
    """Starts of the windows of ``length`` words within a text that hold a hit."""
    n = len(w.hash) - length + 1
    if n <= 0 or not len(hits):
        return np.zeros(0, np.int64)
    seen = np.zeros(len(w.hash) + 1, dtype=np.int64)
    seen[hits + 1] = 1
    seen = np.cumsum(seen)
    owner = w.owner()
    start = np.arange(n)
    return start[(owner[:n] == owner[length - 1 :]) & (seen[start + length - block + 1] > seen[start])]


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text), a row per document.

    A window is ``length`` consecutive words of one document, unchanged. Every word covered by a window whose sequence
    also starts in a document of smaller doc_id is removed; windows are judged on the input. kept_text has the other
    words, joined by one space. A null or empty text has no words. Rows with the same doc_id do not count against
    each other. Other columns are ignored; an empty table gives no rows. Memory follows the longest text.
    """
    if length < 2:
        raise ValueError("a window has at least two words")
    block = (length + 1) // 2
    bundles, parts = bundles_and_parts(docs)

    def ask(ids: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        _, hashes, is_block = _probes(Words(texts), block)
        tails, inverse, part = unique_keys(hashes, parts, _BITS)
        blocks = np.minimum(np.bincount(inverse[is_block], minlength=len(tails)), 2).astype(np.uint8)
        for p, a, b in cuts_by_part(part):
            yield p, pack(*planes(tails[a:b], _BITS // 8), blocks[a:b])

    def look_up(bundle_ids: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        rows = [(joined(b[:-1]), b[-1]) for b in map(unpack, blobs)]
        unique, inverse = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([r[1] for r in rows]), minlength=len(unique))
        found = np.split(np.minimum(total, 2).astype(np.uint8)[inverse], np.cumsum([len(r[0]) for r in rows])[:-1])
        for b, f in zip(bundle_ids, found):
            yield b, pack(f)

    def extend(bundle_id: int, ids: np.ndarray, texts: list[bytes], got: dict[int, bytes]) -> list[tuple]:
        w = Words(texts)
        at, hashes, is_block = _probes(w, block)
        if not len(at):
            return []
        blocks = np.concatenate([unpack(got[p])[0] for p in sorted(got)])[unique_keys(hashes, parts, _BITS)[1]]
        # A window that is itself a block needs another one.
        start = _windows(w, at[blocks > is_block], length, block)
        if not len(start):
            return []
        one, two = window_hashes(w.hash, length)[start], window_hashes(w.second_hash(), length, BASE_B)[start]
        doc = ids[w.owner()[start]]
        order = np.lexsort((doc, two, one))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        lead = order[new]  # of each distinct window the occurrence in the least document
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        rows = [(p, bundle_id, pack(one[lead[a:b]], two[lead[a:b]], doc[lead[a:b]])) for p, a, b in cuts_by_part(part_of(one[lead], parts))]
        return [*rows, (-1, bundle_id, pack(start.astype(np.uint32), which.astype(np.uint32), doc > doc[lead][which]))]

    def least(bundle_ids: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        rows = [unpack(b) for b in blobs]
        one, two, doc = (np.concatenate([r[k] for r in rows]) for k in range(3))
        order = np.lexsort((doc, two, one))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        first = doc[order[new]][np.cumsum(new) - 1]
        earlier = np.empty(len(order), dtype=bool)
        earlier[order] = first < doc[order]
        for b, e in zip(bundle_ids, np.split(earlier, np.cumsum([len(r[0]) for r in rows])[:-1])):
            yield b, pack(e)

    def cut(bundle_id: int, ids: np.ndarray, texts: list[bytes], got: dict[int, bytes]) -> list[tuple]:
        w = Words(texts)
        gone = np.zeros(len(w.hash), dtype=bool)
        if -1 in got:
            start, which, later = unpack(got[-1])
            earlier = np.concatenate([unpack(got[p])[0] for p in sorted(got) if p >= 0])
            start = start[later | earlier[which]].astype(np.int64)
            cover = np.zeros(len(w.hash) + 1, dtype=np.int64)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + length, -1)
            gone = np.cumsum(cover[:-1]) > 0
        rows = []
        for i, t in enumerate(texts):
            a, b = w.first[i], w.first[i + 1]
            words, out = t.split(), gone[a:b]
            n = int(out.sum())
            kept = [x for x, g in zip(words, out.tolist()) if not g] if n else words
            rows.append((int(ids[i]), int(b - a), n, b" ".join(kept).decode()))
        return rows

    found = materialize(answer_parts(requests(bundles, ask), look_up))
    windows = materialize(meet(bundles, found, extend, REQUEST_ARROW, REQUEST))
    forget(found)
    judged = materialize(answer_parts(windows.where("part >= 0"), least).unionByName(windows.where("part = -1").select("bundle_id", "part", "blob")))
    forget(windows)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
    return meet(bundles, judged, cut, schema, "doc_id long, n_words long, n_removed long, kept_text string")


def with_digest(rows: DataFrame, text: str = "kept_text") -> DataFrame:
    """``kept_sha256`` in place of the kept text."""
    return rows.withColumn("kept_sha256", F.sha2(text, 256)).drop(text)

