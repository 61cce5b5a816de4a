"""SentencePiece encoding and decoding of whole documents, giant ones in parallel.

Method: max-plus parallel scan. A model trained for merges segments a text into the one sequence of pieces of which
every two neighbours are compatible, that is, stay as they are when they are merged alone; so its segmentation is a path
over text positions whose edges are pieces and whose steps must be compatible. A giant document is split into chunks
at any place. A boundary's states are the pieces that can lie across it or end at it; a chunk's transfer matrix has, for
each state before and after it, the score of the compatible path in between, minus infinity where there is none.
Matrices combine associatively with (max, +); once each boundary's state is known, every chunk is traced back by itself.

Ids are those of the sentencepiece library for the same file. Where no piece lies across the place before a space mark,
texts are cut there and the parts looked up in a cache.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gather, materialize, pick, slices

#: Documents above this many characters are split into chunks of this many.
CHUNK_CHARS = 32_768
#: Chunks that one task walks.
CHUNKS_PER_TASK = 100
#: Words, and stretches with marks, that a worker keeps; a worker outlives its stage, so they are few.
_CACHE_WORDS, _CACHE_UNITS, _CACHE_PAIRS = 100_000, 50_000, 30_000
_SPACE = "▁"
_CUT = re.compile(f"{_SPACE}+[^{_SPACE}]*|[^{_SPACE}]+")
_CUT_PLACE = re.compile(f"(?<=[^{_SPACE}])(?={_SPACE})")
_NONE = -np.inf


class Pieces:
    """A model's pieces, the library's encoder with a cache, and compatible paths."""

    def __init__(self, file: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=file)
        self.score: dict[str, float] = {}
        self.piece_id: dict[str, int] = {}
        self.raw: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        for i in range(len(sp)):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.raw.append(b"")
            else:
                self.raw.append(piece.replace(_SPACE, " ").encode())
                self.score[piece], self.piece_id[piece] = sp.get_score(i), i
        self.raw_flat = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_sizes = np.array(list(map(len, self.raw)), dtype=np.int64)
        self.id_score = np.array([sp.get_score(i) for i in range(len(sp))], dtype=np.float64)
        self.longest = max(map(len, self.score), default=1)
        if any(_SPACE in p.lstrip(_SPACE) for p in self.score):
            raise ValueError("a model with pieces across words is not supported")
        self.unknown_score = min(self.score.values(), default=0.0) - 10.0
        self.cache: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.compatible = lru_cache(maxsize=_CACHE_PAIRS)(self._compatible)

    # ---- whole texts

    def encode(self, marked: str) -> bytes:
        """Ids of a text whose spaces are marks and which starts with one."""
        return b"".join(self.of_units(_CUT.findall(marked)))

    def of_units(self, units: list[str]) -> list[bytes]:
        """Ids of each stretch of marks and what follows them."""
        known = list(map(self.cache.get, units))
        missing = list(dict.fromkeys(u for u, x in zip(units, known) if x is None))
        if not missing:
            return known
        # The library puts a mark in front itself.
        ids = self.library.encode([u[1:].replace(_SPACE, " ") if len(u) > 1 else "" for u in missing], num_threads=1)
        new = {u: array("I", x).tobytes() if len(u) > 1 else self.of(u) for u, x in zip(missing, ids)}
        if len(self.cache) < _CACHE_UNITS:
            self.cache.update({u: x for u, x in new.items() if len(u) <= 64})
        return [new[u] if x is None else x for u, x in zip(units, known)]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, a null one being empty. Texts with single spaces only are cut at these, and the different
        words of all of them looked up together."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, f"^ |  | $|^$|{_SPACE}").to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        for i in np.flatnonzero(odd).tolist():
            out[i] = self.encode(mark(texts[i].as_py()))
        at = np.flatnonzero(~odd)
        if len(at):
            lists = pc.split_pattern(texts.take(pa.array(at)), " ")
            words = lists.flatten().dictionary_encode()
            known = self._of_words(words.dictionary.to_numpy(zero_copy_only=False).tolist())
            sizes = np.fromiter(map(len, known), np.int64, len(known)) >> 2
            ids, ends = gather(np.frombuffer(b"".join(known), "<u4"), sizes, words.indices.to_numpy())
            raw, offsets = ids.tobytes(), np.asarray(lists.offsets)
            ends = ends[offsets[1:] - offsets[0] - 1] * 4
            for i, a, b in zip(at.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                out[i] = raw[a:b]
        return out

    def _of_words(self, words: list[str]) -> list[bytes]:
        known = list(map(self.words.get, words))
        missing = [k for k, x in enumerate(known) if x is None]
        for k in range(0, len(missing), 5000):
            some = missing[k : k + 5000]
            for i, x in zip(some, self.library.encode([words[i] for i in some], num_threads=1)):
                known[i] = array("I", x).tobytes()
                if len(self.words) < _CACHE_WORDS and len(words[i]) <= 64:
                    self.words[words[i]] = known[i]
        return known

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all([ids.astype("<u4").tobytes()])[0]

    def decode_all(self, blobs: list[bytes]) -> list[str]:
        ids = np.frombuffer(b"".join(blobs), "<u4")
        flat, ends = gather(self.raw_flat, self.raw_sizes, ids)
        ends = np.append(0, ends)[np.cumsum([0, *(len(x) // 4 for x in blobs)])].tolist()
        raw = flat.tobytes()
        return [raw[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(ends, ends[1:])]

    def of(self, piece: str) -> bytes:
        """Ids of one piece, or of the bytes of a character that is none."""
        if piece in self.piece_id:
            return self.piece_id[piece].to_bytes(4, "little")
        return b"".join(self.byte_ids[x].to_bytes(4, "little") for x in piece.encode()) if self.byte_ids else (self.library.unk_id()).to_bytes(4, "little")

    def weight(self, piece: str) -> float:
        return self.score.get(piece, self.unknown_score)

    # ---- compatible paths

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text: the neighbours whose union scores best are merged, leftmost first, until none can."""
        parts = list(text)
        while True:
            best = max(((self.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None)
            if best is None:
                return parts
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def _compatible(self, a: str, b: str) -> bool:
        return self.merge(a + b) == [a, b]

    def follows(self, before: str | None, piece: str) -> bool:
        if before is None or (piece[0] == _SPACE and before[-1] != _SPACE):
            return self.merge(piece) == [piece]
        return self.compatible(before, piece)

    def is_piece(self, text: str) -> bool:
        return len(text) == 1 or text in self.score

    def walk(self, before: str | None, text: str) -> tuple[list[float], list[int]]:
        """Score of the compatible path from 0 to each place of ``text`` after the piece ``before``, and where its last
        piece begins; at most one such path ends at each place."""
        n = len(text)
        score, back = [_NONE] * (n + 1), [-1] * (n + 1)
        last: list[str | None] = [None] * (n + 1)
        score[0], last[0] = 0.0, before
        for b in range(1, n + 1):
            for a in range(max(0, b - self.longest), b):
                if score[a] != _NONE and self.is_piece(piece := text[a:b]) and self.follows(last[a], piece):
                    score[b], back[b], last[b] = score[a] + self.weight(piece), a, piece
                    break
        return score, back

    def path(self, before: str | None, text: str) -> list[str]:
        back, out, b = self.walk(before, text)[1], [], len(text)
        while b > 0:
            out.append(text[back[b] : b])
            b = back[b]
        return out[::-1]

    def states(self, text: str, at: int) -> list[tuple[int, int]]:
        """Pieces across or up to place ``at``, as characters before and after it; nothing at the start of a text."""
        if at == 0:
            return [(0, 0)]
        room = self.longest
        return [(x, y) for x in range(1, min(room, at) + 1) for y in range(min(room - x, len(text) - at) + 1) if self.is_piece(text[at - x : at + y])]


class Chunk:
    """``size`` characters of a document from place ``lead`` of ``text``, which reaches a piece's length beyond them on
    either side, or to the document's start or end."""

    def __init__(self, p: Pieces, text: str, lead: int, size: int):
        self.p, self.text, self.lead, self.stop = p, text, lead, lead + size
        self.enter, self.leave = p.states(text, lead), p.states(text, self.stop)
        self.cuts = [m.start() for m in _CUT_PLACE.finditer(text)]

    def _ends(self, enter: tuple[int, int], leave: tuple[int, int]) -> tuple[int, int, int, int]:
        """Where the path begins and its last piece begins, and the first and last cut between these places."""
        from bisect import bisect_left, bisect_right

        a, b = self.lead + enter[1], self.stop - leave[0]
        i, j = bisect_left(self.cuts, a), bisect_right(self.cuts, b) - 1
        return (a, b, self.cuts[i], self.cuts[j]) if i <= j else (a, b, -1, -1)

    def _before(self, enter: tuple[int, int]) -> str | None:
        x, y = enter
        return self.text[self.lead - x : self.lead + y] or None

    def matrix(self) -> np.ndarray:
        out = np.full((len(self.enter), len(self.leave)), _NONE)
        units = self.p.of_units([self.text[a:b] for a, b in zip(self.cuts, self.cuts[1:])])
        sums = np.append(0.0, np.cumsum(self.p.id_score[np.frombuffer(b"".join(units), "<u4")]))
        total = dict(zip(self.cuts, sums[np.cumsum([0, *(len(u) // 4 for u in units)])].tolist()))
        heads: dict = {}
        tails: dict = {}
        for i, enter in enumerate(self.enter):
            before = self._before(enter)
            for j, leave in enumerate(self.leave):
                a, b, first, last = self._ends(enter, leave)
                if a > b:
                    continue
                piece = self.text[b : self.stop + leave[1]]
                if first < 0:
                    key = (i, -1)
                    if key not in heads:
                        heads[key] = self._walk(before, a, self.stop)
                    score, pieces = heads[key]
                    so_far, prior = score[b - a], pieces(b - a) if b > a else before
                else:
                    key = (i, first)
                    if key not in heads:
                        heads[key] = self._walk(before, a, first)
                    if last not in tails:
                        tails[last] = self._walk(None, last, self.stop)
                    score, pieces = tails[last]
                    so_far = heads[key][0][first - a] + total[last] - total[first] + score[b - last]
                    # At a cut any piece may follow.
                    prior = pieces(b - last) if b > last else None
                if so_far != _NONE and self.p.follows(prior, piece):
                    out[i, j] = so_far + self.p.weight(piece)
        return out

    def _walk(self, before: str | None, a: int, b: int):
        text = self.text[a:b]
        score, back = self.p.walk(before, text)
        return score, lambda k: text[back[k] : k] if back[k] >= 0 else None

    def trace(self, enter: int, leave: int) -> bytes:
        """Ids of the pieces after state ``enter`` up to and with state ``leave``."""
        before, out = self._before(self.enter[enter]), self.leave[leave]
        a, b, first, last = self._ends(self.enter[enter], out)
        end = self.text[b : self.stop + out[1]]
        of = lambda pieces: b"".join(map(self.p.of, pieces))
        if first < 0:
            return of([*self.p.path(before, self.text[a:b]), end])
        return of(self.p.path(before, self.text[a:first])) + self.p.encode(self.text[first:last]) + of([*self.p.path(None, self.text[last:b]), end])


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (max, +) products of two stacks of matrices."""
    out = np.full((*a.shape[:-1], b.shape[-1]), _NONE)
    for k in range(a.shape[-1]):
        np.maximum(out, a[..., :, k, None] + b[..., None, k, :], out=out)
    return out


def prefix_scan(stack: np.ndarray) -> np.ndarray:
    """Products of the first 1, 2, ... matrices, by doubling; the product is associative."""
    out, step = stack.copy(), 1
    while step < len(out):
        out[step:] = combine(out[:-step], out[step:])
        step *= 2
    return out


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """States of the best path before the first, after the first, ... and after the last chunk."""
    width = max(max(m.shape) for m in matrices)
    stack = np.full((len(matrices), width, width), _NONE)
    for k, m in enumerate(matrices):
        stack[k, : m.shape[0], : m.shape[1]] = m
    done = prefix_scan(stack)
    states = [int(np.argmax(done[-1][0]))]
    for k in range(len(stack) - 1, 0, -1):
        states.append(int(np.argmax(done[k - 1][0] + stack[k][:, states[-1]])))
    return [0, *states[::-1]]


def mark(text: str) -> str:
    return _SPACE + text.replace(" ", _SPACE) if text else ""


_PIECES: dict[str, Pieces] = {}


def pieces(file: str) -> Pieces:
    """The model of this worker process, with its cache."""
    if file not in _PIECES:
        _PIECES[file] = Pieces(file)
    return _PIECES[file]


_IDS = "doc_id long, ids binary"


def encode(docs: DataFrame, model_file: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, ids), ids as little-endian unsigned 32-bit integers, a row per document. A null or empty text has no
    ids. Other columns are ignored, repeated rows encoded each. An empty table gives no rows."""
    plain = pick(docs, "doc_id", "text")
    giant = F.coalesce(F.length("text"), F.lit(0)) > chunk_chars

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model_file)
        for b in batches:
            for doc_ids, texts in slices(b):
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(p.encode_all(texts), pa.binary())], ["doc_id", "ids"])

    return plain.where(~giant).mapInArrow(small, _IDS).unionByName(_encode_giant(plain.where(giant), model_file, chunk_chars))


def _encode_giant(docs: DataFrame, model_file: str, chunk_chars: int) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = pieces(model_file).longest
        size = max(chunk_chars, reach)  # no chunk is shorter, so that a piece lies across one boundary at most
        for b in batches:
            for doc_id, copy, text in zip(*b.columns):
                t = mark(text.as_py())
                starts = list(range(0, max(1, len(t) - size + 1), size))
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(t)])):
                    low = max(0, a - reach)
                    row = {"doc_id": doc_id.as_py(), "copy": copy.as_py(), "chunk": k, "lead": a - low, "size": b - a, "part": t[low : b + reach]}
                    yield pa.RecordBatch.from_pylist([row], schema=schema)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model_file)
        for b in batches:
            found = [Chunk(p, r["part"], r["lead"], r["size"]).matrix() for r in b.to_pylist()]
            cols = [pa.array([m.shape[0] for m in found], pa.int32()), pa.array([m.tobytes() for m in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *cols], ["doc_id", "copy", "chunk", "rows", "matrix"])

    def states(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        at = boundary_states([np.frombuffer(m.as_py()).reshape(n.as_py(), -1) for n, m in zip(table.column("rows"), table.column("matrix"))])
        return pa.table({"doc_id": table.column("doc_id"), "copy": table.column("copy"), "chunk": table.column("chunk"), "enter": pa.array(at[:-1], pa.int32()), "leave": pa.array(at[1:], pa.int32())})

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model_file)
        for b in batches:
            rows = b.select(["part", "lead", "size", "enter", "leave"]).to_pylist()
            ids = [Chunk(p, r["part"], r["lead"], r["size"]).trace(r["enter"], r["leave"]) for r in rows]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("copy"), b.column("chunk"), pa.array(ids, pa.binary())], ["doc_id", "copy", "chunk", "ids"])

    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        return pa.table({"doc_id": table.column("doc_id")[:1], "ids": pa.array([b"".join(table.column("ids").to_pylist())], pa.binary())})

    schema = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("chunk", pa.int32()), ("lead", pa.int32()), ("size", pa.int32()), ("part", pa.string())])
    # copy tells rows apart that repeat a doc_id
    numbered = docs.select("doc_id", F.monotonically_increasing_id().alias("copy"), "text")
    chunks = materialize(numbered.mapInArrow(split, "doc_id long, copy long, chunk int, lead int, size int, part string"))
    # Chunks are dealt out evenly, whichever files the giants were in.
    dealt = max(1, -(-chunks.count() // CHUNKS_PER_TASK))
    found = chunks.repartition(dealt, "doc_id", "copy", "chunk").mapInArrow(matrices, "doc_id long, copy long, chunk int, rows int, matrix binary")
    at = found.groupBy("doc_id", "copy").applyInArrow(states, "doc_id long, copy long, chunk int, enter int, leave int")
    ids = chunks.join(at.hint("merge"), ["doc_id", "copy", "chunk"]).mapInArrow(traced, "doc_id long, copy long, chunk int, ids binary")
    return ids.groupBy("doc_id", "copy").applyInArrow(joined, _IDS)


def decode(ids: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids are the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model_file)
        for b in batches:
            for doc_ids, ids in slices(b):
                texts = p.decode_all([x or b"" for x in ids.to_pylist()])
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(texts, pa.string())], ["doc_id", "text"])

    return pick(ids, "doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_file: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, decoded_chars, decoded_sha256): encode every text and decode its ids again."""
    ids = encode(docs, model_file, chunk_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model_file)
        for doc_ids, ids in (x for b in batches for x in slices(b)):
            blobs = [x or b"" for x in ids.to_pylist()]
            texts = p.decode_all(blobs)
            cols = [[len(x) // 4 for x in blobs], [zlib.crc32(x) for x in blobs], [len(t) for t in texts]]
            yield pa.RecordBatch.from_arrays([doc_ids, *[pa.array(c, pa.int64()) for c in cols], pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())], ["doc_id", "n_pieces", "ids_crc32", "decoded_chars", "decoded_sha256"])

    return ids.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, decoded_chars long, decoded_sha256 string")
