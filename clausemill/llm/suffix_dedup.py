"""Suffix-array dedup: remove long byte strings that start earlier in the corpus.

Method: depth-limited radix sort. Suffixes are ordered only through their first LENGTH bytes, by passes over eight-byte
digits, most significant first; groups of one drop out after each pass, and the groups left at the end are exactly the
repeated windows.

Not every suffix is moved to be sorted. A window's anchor is its 50-byte string of least hash (the leftmost, if
several are least), so equal windows have equal anchors at the same place in them. The windows of one anchor occurrence
are consecutive: a run. Runs whose anchor string occurs once in the corpus hold no repeated window and stay where they
are. The others go, as the few bytes that they span, to the task of their anchor string. There the same sort finds
equal runs, and where an anchor stands in different runs, it orders the suffixes at all window starts of these.

An anchor with more than _HOT runs, counted once in each bundle, would be more than one task should sort. Its windows are re-keyed, each by
128 bits of its own bytes, and Spark aggregates the least place of each with partial sums on the map side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ANSWER, BASE_B, REQUEST, REQUEST_ARROW, answer_parts, arrow_rows, bundles_and_parts, cuts_by_part, forget, joined, materialize, meet, mix64, pack, part_of, planes, requests, span_hashes, unique_keys, unpack, window_hashes

_BITS = 32
#: Bytes of a bundle that are hashed at once; positions within a slice must fit into _PLACE bits.
_SLICE = 1 << 19
_PLACE = 20
#: Suffixes that one radix sort holds in memory.
_SORTED = 200_000
#: Runs of one anchor string that one task sorts.
_HOT = 10_000
#: Parts of the blobs that hold a bundle's own notes, its windows of hot anchors, and the judgement of these.
_NOTES, _HOT_WINDOWS, _HOT_LATER = -1, -2, -3


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - have :]) if width > have else out


class Runs:
    """The runs of a bundle: first window start, number of windows, anchor place, text and anchor hash of each."""

    def __init__(self, texts: list[bytes], length: int):
        self.anchor_size = length // 2
        reach = length - self.anchor_size + 1  # anchor places in a window
        self.buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.text_at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        at, anchor, hashes = [], [], []
        for a in range(0, len(self.buf) - length + 1, _SLICE):
            part = self.buf[a : a + _SLICE + length - 1]
            keys = window_hashes(part, self.anchor_size)
            place = np.uint64((1 << _PLACE) - 1)
            best = (_least((keys & ~place) | np.arange(len(keys), dtype=np.uint64), reach) & place).astype(np.int64)
            best = best[: min(_SLICE, len(part) - length + 1)]
            start = np.arange(len(best))
            owner = np.searchsorted(self.text_at, a + start, side="right") - 1 if len(texts) > 1 else np.zeros(len(best), np.int64)
            inside = a + start + length <= self.text_at[owner + 1]
            new = np.ones(len(best), dtype=bool)
            new[1:] = (best[1:] != best[:-1]) | (inside[1:] != inside[:-1])
            first = np.flatnonzero(new)
            good = inside[first]
            sizes = np.diff(np.append(first, len(best)))[good]
            first = first[good]
            at.append(np.stack([a + first, sizes]))
            anchor.append(a + best[first])
            # Anchors are least hashes; mixed again, they spread over all parts.
            hashes.append(mix64(keys[best[first]]))
        both = np.concatenate(at, axis=1) if at else np.zeros((2, 0), np.int64)
        self.start, self.size = both
        self.anchor = np.concatenate(anchor) if anchor else np.zeros(0, np.int64)
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.text = np.searchsorted(self.text_at, self.start, side="right") - 1


def radix_groups(suffixes: np.ndarray) -> np.ndarray:
    """Group numbers of equal rows of a byte matrix, -1 for rows that are alone: most-significant-digit passes over
    eight-byte digits, groups of one dropping out after each."""
    n, depth = suffixes.shape
    rows, group = np.arange(n), np.zeros(n, dtype=np.int64)
    for d in range(0, depth, 8):
        digit = np.zeros((len(rows), 8), dtype=np.uint8)
        digit[:, : min(8, depth - d)] = suffixes[rows, d : d + 8]
        digit = digit.view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((digit, group))
        rows, group, digit = rows[order], group[order], digit[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        ids = np.cumsum(new) - 1
        some = np.bincount(ids)[ids] > 1 if len(ids) else np.zeros(0, bool)
        rows, group = rows[some], ids[some]
        if not len(rows):
            break
    out = np.full(n, -1, dtype=np.int64)
    out[rows] = group
    return out


def equal_runs(raw: np.ndarray, start: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the runs of ``size`` windows at ``raw[start]``, from 0, the same for equal ones."""
    if not len(start):
        return np.zeros(0, dtype=np.int64)
    width = int(size.max()) + length - 1
    rows = np.empty((len(start), width + 1), dtype=np.uint8)
    rows[:, 1:] = np.lib.stride_tricks.sliding_window_view(np.concatenate([raw, np.zeros(width, np.uint8)]), width)[start]
    rows[:, 1:][np.arange(width) >= (size + length - 1)[:, None]] = 0
    rows[:, 0] = size
    group = radix_groups(rows)
    alone = group < 0
    kind = np.empty(len(start), dtype=np.int64)
    met, kind[~alone] = np.unique(group[~alone], return_inverse=True)
    kind[alone] = len(met) + np.arange(int(alone.sum()))
    return kind


def _judge(anchor: np.ndarray, kind: np.ndarray, offset: np.ndarray, size: np.ndarray, rank: np.ndarray, at: np.ndarray, raw: np.ndarray, length: int) -> np.ndarray:
    """For each run the bit mask of its windows that start earlier as well. ``kind`` numbers equal runs, ``offset`` is
    the anchor's place in the run, ``rank`` the order in the corpus, ``raw[at:]`` the bytes."""
    n = len(anchor)
    order = np.lexsort((rank, kind))
    new = np.ones(n, dtype=bool)
    new[1:] = kind[order][1:] != kind[order][:-1]
    lead = order[new]  # the first run of each kind, ascending in kind
    mask = np.zeros(n, dtype=np.uint64)
    full = np.where(size < 64, (np.uint64(1) << size.astype(np.uint64)) - np.uint64(1), ~np.uint64(0))
    later = rank > rank[lead][kind]
    mask[later] = full[later]
    # Anchors with several kinds of run: equal windows of different kinds.
    by = lead[np.argsort(anchor[lead], kind="stable")]
    bounds = np.flatnonzero(np.append(True, anchor[by][1:] != anchor[by][:-1]))
    sizes = np.diff(np.append(bounds, len(by)))
    step: list[np.ndarray] = []
    held = 0
    several = np.flatnonzero(sizes > 1)
    extra: dict[int, int] = {}
    for k, g in enumerate(several.tolist()):
        own = by[bounds[g] : bounds[g] + sizes[g]]
        step.append(own)
        held += int(size[own].sum())
        if held >= _SORTED or k == len(several) - 1:
            _sort_step(np.concatenate(step), anchor, offset, size, rank, at, raw, length, extra)
            step, held = [], 0
    if extra:
        more = np.zeros(len(lead), dtype=np.uint64)
        where = {r: i for i, r in enumerate(lead.tolist())}
        for r, m in extra.items():
            more[where[r]] = m
        # A window of a kind that starts earlier in another kind starts earlier for the kind's first run.
        mask[lead] |= more
    return mask


def _sort_step(runs: np.ndarray, anchor: np.ndarray, offset: np.ndarray, size: np.ndarray, rank: np.ndarray, at: np.ndarray, raw: np.ndarray, length: int, out: dict[int, int]) -> None:
    """Radix sort of the suffixes at all window starts of the runs; adds to ``out`` the windows not first in a group."""
    owner = np.repeat(np.arange(len(runs)), size[runs])
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size[runs]) - size[runs], size[runs])
    rows = np.lib.stride_tricks.sliding_window_view(raw, length)[at[runs][owner] + place]
    group = radix_groups(rows)
    some = np.flatnonzero(group >= 0)
    if not len(some):
        return
    order = some[np.lexsort((rank[runs][owner[some]], group[some]))]
    first = np.ones(len(order), dtype=bool)
    first[1:] = group[order][1:] != group[order][:-1]
    for i in order[~first].tolist():
        r = int(runs[owner[i]])
        out[r] = out.get(r, 0) | 1 << int(place[i])


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), a row per document; ``kept`` is binary.

    Texts are UTF-8 bytes, null ones empty; matches never cross documents. A byte goes if a string of ``length`` bytes
    that covers it also starts earlier: in a document of smaller doc_id, or earlier in the same one, overlaps
    included, judged on the input. n_spans counts maximal removed stretches. The kept bytes need not be whole
    characters. Of rows with the same doc_id the one met first counts as the earlier. Other columns are ignored; an
    empty table gives no rows. Memory follows the longest text. ``length`` is 16 to 120.
    """
    if not 16 <= length <= 120:
        raise ValueError("length must be from 16 to 120")
    bundles, parts = bundles_and_parts(docs)

    def ask(ids: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        runs = Runs(texts, length)
        tails, inverse, part = unique_keys(runs.hash, parts, _BITS)
        several = np.bincount(inverse, minlength=len(tails)) > 1
        # Different runs of the anchor; equal ones of a bundle travel once.
        kinds = np.ones(len(tails), dtype=np.uint32)
        at = np.flatnonzero(several[inverse])
        text = span_hashes(runs.buf, runs.start[at], runs.start[at] + runs.size[at] + length - 1)
        order = np.lexsort((text, inverse[at]))
        new = np.ones(len(at), dtype=bool)
        new[1:] = (inverse[at][order][1:] != inverse[at][order][:-1]) | (text[order][1:] != text[order][:-1])
        np.add.at(kinds, inverse[at][order[new]], 1)
        kinds[several] -= 1
        for p, a, b in cuts_by_part(part):
            yield p, pack(*planes(tails[a:b], _BITS // 8), kinds[a:b], np.packbits(several[a:b]))

    def repeated(bundle_ids: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        rows = [(joined(b[:-2]), b[-2], np.unpackbits(b[-1], count=len(b[-2]))) for b in map(unpack, blobs)]
        unique, inverse = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
        kinds, several = (np.concatenate([r[k] for r in rows]) for k in (1, 2))
        times = np.bincount(inverse, weights=1.0 + several, minlength=len(unique))
        found = ((times > 1).astype(np.uint8) + (np.bincount(inverse, weights=kinds, minlength=len(unique)) > _HOT))[inverse]
        for b, f in zip(bundle_ids, np.split(found, np.cumsum([len(r[0]) for r in rows])[:-1])):
            yield b, pack(f)

    def send(bundle_id: int, ids: np.ndarray, texts: list[bytes], got: dict[int, bytes]) -> list[tuple]:
        runs = Runs(texts, length)
        if not len(runs.hash):
            return []
        found = np.concatenate([unpack(got[p])[0] for p in sorted(got)])[unique_keys(runs.hash, parts, _BITS)[1]]
        at = np.flatnonzero(found)
        if not len(at):
            return []
        start, size, anchor, key, hot = runs.start[at], runs.size[at], runs.anchor[at], runs.hash[at], found[at] > 1
        doc, pos = ids[runs.text[at]], anchor - runs.text_at[runs.text[at]]
        kind = equal_runs(runs.buf, start, size, length)
        # The first run of each kind speaks for the others; these leaders are numbered by their key.
        order = np.lexsort((pos, doc, kind))
        new = np.append(True, kind[order][1:] != kind[order][:-1])
        lead = order[new]
        by_key = np.argsort(key[lead], kind="stable")
        lead, number = lead[by_key], np.empty(len(lead), dtype=np.int64)
        number[by_key] = np.arange(len(lead))
        first = np.zeros(len(at), dtype=bool)
        first[lead] = True
        raw, plain, rows = runs.buf.tobytes(), lead[~hot[lead]], []
        for p, a, b in cuts_by_part(part_of(key[plain], parts)):
            m = plain[a:b]
            body = np.frombuffer(b"".join([raw[x:y] for x, y in zip(start[m].tolist(), (start[m] + size[m] + length - 1).tolist())]), np.uint8)
            rows.append((p, bundle_id, pack(key[m], (anchor - start)[m].astype(np.uint8), size[m].astype(np.uint8), doc[m], pos[m], body)))
        own = lead[hot[lead]]
        step = max(1, _SORTED // length)
        for a in range(0, len(own), step):
            m = own[a : a + step]
            which = np.repeat(np.arange(len(m)), size[m])
            place = start[m][which] + np.arange(len(which)) - np.repeat(np.cumsum(size[m]) - size[m], size[m])
            hashes = []
            for base in (None, BASE_B):
                # A run's windows follow each other in the buffer; hash each run's stretch by itself.
                stretch = [window_hashes(runs.buf[x : x + n + length - 1], length, *([base] if base else [])) for x, n in zip(start[m].tolist(), size[m].tolist())]
                hashes.append(np.concatenate(stretch))
            rows.append((_HOT_WINDOWS, bundle_id, pack(*hashes, doc[m][which], place - runs.text_at[runs.text[at[m]]][which], np.int64(a) + which, place - start[m][which])))
        return [*rows, (_NOTES, bundle_id, pack(start.astype(np.int64), size.astype(np.uint8), number[kind].astype(np.uint32), first, hot[lead]))]

    def sort(bundle_ids: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        rows = [unpack(b) for b in blobs]
        key, offset, size, doc, pos, raw = (np.concatenate([r[k] for r in rows]) for k in range(6))
        size = size.astype(np.int64)
        at = np.concatenate([[0], np.cumsum(size + length - 1)])[:-1]
        rank = np.empty(len(key), dtype=np.int64)
        rank[np.lexsort((pos, doc))] = np.arange(len(key))
        mask = _judge(key, equal_runs(raw, at, size, length), offset.astype(np.int64), size, rank, at, raw, length)
        for b, m in zip(bundle_ids, np.split(mask, np.cumsum([len(r[0]) for r in rows])[:-1])):
            yield b, pack(m)

    def cut(bundle_id: int, ids: np.ndarray, texts: list[bytes], got: dict[int, bytes]) -> list[tuple]:
        text_at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        cover = np.zeros(int(text_at[-1]) + 1, dtype=np.int32)
        if _NOTES in got:
            start, size, which, first, hot = unpack(got[_NOTES])
            masks = np.zeros(len(hot), dtype=np.uint64)
            masks[~hot] = np.concatenate([np.zeros(0, np.uint64), *[unpack(got[p])[0] for p in sorted(got) if p >= 0]])
            if _HOT_LATER in got:
                run, place = unpack(got[_HOT_LATER])
                np.bitwise_or.at(masks, np.flatnonzero(hot)[run], np.uint64(1) << place.astype(np.uint64))
            mask = masks[which]
            # A run that an equal one of this bundle comes before is repeated as a whole.
            whole = ~first
            np.add.at(cover, start[whole], 1)
            np.add.at(cover, start[whole] + size[whole] + length - 1, -1)
            for k in range(int(size.max())):
                on = first & ((mask >> np.uint64(k)) & np.uint64(1)).astype(bool)
                np.add.at(cover, start[on] + k, 1)
                np.add.at(cover, start[on] + k + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        rows = []
        for i, t in enumerate(texts):
            out = gone[text_at[i] : text_at[i + 1]]
            n = int(out.sum())
            spans = int(out[:1].sum() + (out[1:] & ~out[:-1]).sum()) if n else 0
            kept = np.frombuffer(t, np.uint8)[~out].tobytes() if n else t
            rows.append((int(ids[i]), len(t), n, spans, kept))
        return rows

    found = materialize(answer_parts(requests(bundles, ask), repeated))
    runs = materialize(meet(bundles, found, send, REQUEST_ARROW, REQUEST))
    forget(found)
    judged = answer_parts(runs.where("part >= 0"), sort).unionByName(runs.where(f"part = {_NOTES}").select("bundle_id", "part", "blob"))
    judged = materialize(judged.unionByName(_hot_later(runs.where(f"part = {_HOT_WINDOWS}"))))
    forget(runs)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    return meet(bundles, judged, cut, schema, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _hot_later(runs: DataFrame) -> DataFrame:
    """Of the windows of hot anchors those that start earlier as well: a blob for each bundle that has some."""
    names = ["bundle_id", "one", "two", "doc", "pos", "run", "place"]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bundle_id, blob in zip(b.column(0).to_pylist(), b.column(1)):
                one, two, *rest = unpack(blob.as_py())
                cols = [np.full(len(one), bundle_id), one.view(np.int64), two.view(np.int64), *rest]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    rows = runs.select("bundle_id", "blob").mapInArrow(windows, ", ".join(f"{n} long" for n in names))
    at = F.struct("doc", "pos", "bundle_id", "run")
    least = rows.groupBy("one", "two").agg(F.min(at).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Hot windows grow with the corpus: a merge join at every size, whose large keys Spark splits.
    later = rows.join(least.hint("merge"), ["one", "two"]).where(at > F.col("least")).select("bundle_id", "run", "place")

    def packed(table: pa.Table) -> pa.Table:
        blob = pack(*(table.column(c).to_numpy().astype(t) for c, t in (("run", np.int64), ("place", np.uint8))))
        return arrow_rows(_ANSWER_ARROW, [(table.column("bundle_id")[0].as_py(), _HOT_LATER, blob)])

    return later.groupBy("bundle_id").applyInArrow(packed, ANSWER)


_ANSWER_ARROW = pa.schema([("bundle_id", pa.int64()), ("part", pa.int32()), ("blob", pa.binary())])
