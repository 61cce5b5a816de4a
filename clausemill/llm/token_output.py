r"""Token-ID output: documents as one long sequence of token ids in bit-packed shard files, and back.

Method: patched frame-of-reference blocks. A block subtracts its minimum, packs all values at the width that a given
percentile of them needs, and keeps the high bits of the others in an exception list; an index holds block starts.

A shard is written through Spark's own file committer, one row per section; a section ends with \n, which is part of
the format:

    header    "CMT1"
    block     n u32, minimum u32, width u8, exceptions u32, packed bits, positions u32[], high bits u32[]
    index     block offsets u64[], block first-id ordinals u64[], doc_id i64[], doc starts u64[], doc sizes u64[]
    trailer   blocks u64, docs u64, index offset u64, "CMT1"
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import gather, materialize, pick, scratch_dir, slices, text_bytes

MAGIC = b"CMT1"
_JOIN = "\x01"
_STARTS = "\n" + _JOIN
BLOCK_IDS = 4096
_CACHE_SIZE = 200_000


def pack_block(ids: np.ndarray, percentile: float = 90.0) -> bytes:
    """One block of ids, at most BLOCK_IDS of them."""
    low = int(ids.min()) if len(ids) else 0
    rest = ids.astype(np.uint32) - np.uint32(low)
    k = -(-(len(ids) - 1) * percentile // 100)  # the next higher value at that share
    width = int(np.partition(rest, int(k))[int(k)]).bit_length() if len(ids) else 0
    at = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, dtype=np.int64)
    bits = np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    packed = np.packbits(bits.ravel(), bitorder="little").tobytes()
    return struct.pack("<IIBI", len(ids), low, width, len(at)) + packed + at.astype("<u4").tobytes() + (rest[at] >> np.uint32(width)).astype("<u4").tobytes()


def unpack_block(raw: bytes, at: int = 0) -> np.ndarray:
    n, low, width, exceptions = struct.unpack_from("<IIBI", raw, at)
    at += 13
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(raw, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    # A row of bits, padded to four bytes, is the value in little-endian order.
    whole = np.zeros((n, 32), dtype=np.uint8)
    whole[:, :width] = bits
    out = np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel().copy()
    at += size
    where = np.frombuffer(raw, "<u4", exceptions, at)
    out[where] |= np.frombuffer(raw, "<u4", exceptions, at + 4 * exceptions) << np.uint32(width)
    return out + np.uint32(low)


class ShardWriter:
    """Sections of one shard, as they fill up."""

    def __init__(self, percentile: float):
        self.percentile, self.held, self.n_held = percentile, [], 0
        self.offset, self.total = len(MAGIC) + 1, 0
        self.blocks: list[tuple[int, int]] = []
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int, ids: np.ndarray) -> Iterator[bytes]:
        self.docs.append((doc_id, self.total + self.n_held, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK_IDS:
            yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[bytes]:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        stop = len(ids) if last else len(ids) - len(ids) % BLOCK_IDS
        for a in range(0, stop, BLOCK_IDS):
            block = pack_block(ids[a : min(a + BLOCK_IDS, stop)], self.percentile)
            self.blocks.append((self.offset, self.total))
            self.total += min(BLOCK_IDS, stop - a)
            self.offset += len(block) + 1
            yield block
        self.held, self.n_held = [ids[stop:]], len(ids) - stop

    def close(self) -> Iterator[bytes]:
        yield from self.flush(True)
        blocks = np.array(self.blocks, dtype="<u8").reshape(-1, 2)
        docs = np.array(self.docs, dtype="<i8").reshape(-1, 3)
        index = b"".join(np.ascontiguousarray(c).tobytes() for c in (*blocks.T, *docs.T))
        yield index
        yield struct.pack("<QQQ", len(blocks), len(docs), self.offset) + MAGIC


class Shard:
    """A shard file's bytes; any document can be read by itself, through the index of block starts."""

    def __init__(self, raw: bytes):
        blocks, docs, at = struct.unpack_from("<QQQ", raw, len(raw) - 29)
        if raw[-5:-1] != MAGIC or raw[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        self.raw = raw
        self.offsets, self.firsts = (np.frombuffer(raw, "<u8", blocks, at + 8 * blocks * k) for k in range(2))
        at += 16 * blocks
        self.doc_ids, self.starts, self.sizes = (np.frombuffer(raw, "<i8", docs, at + 8 * docs * k) for k in range(3))

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids start .. start + n of the shard's sequence."""
        if n <= 0:
            return np.zeros(0, np.uint32)
        a = int(np.searchsorted(self.firsts, start, side="right")) - 1
        b = int(np.searchsorted(self.firsts, start + n, side="left"))
        got = np.concatenate([unpack_block(self.raw, int(o)) for o in self.offsets[a:b]])
        skip = start - int(self.firsts[a])
        return got[skip : skip + n]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc_id, start in the shard, ids) of every document, each block unpacked once."""
        held, at, nxt = np.zeros(0, np.uint32), 0, 0
        for doc_id, start, n in zip(self.doc_ids.tolist(), self.starts.tolist(), self.sizes.tolist()):
            if at + len(held) < start + n:
                more, have = [held[start - at :]], at + len(held) - start
                while have < n:
                    more.append(unpack_block(self.raw, int(self.offsets[nxt])))
                    have += len(more[-1])
                    nxt += 1
                held, at = np.concatenate(more), start
            yield doc_id, start, held[start - at : start - at + n]


class CachedEncoder:
    """Encodes like the tokenizer file does, with a cache of stretches of text.

    The file's pre-tokenizer always cuts where white space follows something else, and a single line break is a token
    of its own; so is, in any case, what marks follow a Latin letter. So texts without two white spaces in a row are cut
    before each space, line break and such marks; the different parts of a batch are looked up in the cache or encoded,
    and their ids put together. Other texts, and those that
    hold the string of an added token or the control that marks such cuts, are encoded whole. The first _CACHE_SIZE different parts are kept; others are
    encoded once for each batch, many in one call, with line breaks between them.
    """

    #: A superset of what any pre-tokenizer takes for white space.
    _white = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

    #: Marks after a Latin letter: a part that holds them starts with _JOIN, which no space precedes.
    _marks = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}])([.,;:!?#*%]+)"

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        w = self._white
        self._odd = "|".join([r"\x{1}", f"{w}{w}", f"^{w}", f"{w}$", *[rf"\Q{t}\E" for t in added]])
        line = self._whole(["a\nb"])[0]
        if len(line) != 3 or self._whole(["\n"])[0] != line[1:2] or self._whole(["a\n b"])[0][1:2] != line[1:2]:
            raise ValueError("the tokenizer does not cut at line breaks")
        if any(self._whole([f"é{m}{x}"])[0] != [*self._whole(["é"])[0], *self._whole([m + x])[0]] for m in ".,;:!?#*%" for x in ("", m, "a", " a")):
            raise ValueError("the tokenizer does not cut between letters and marks")
        self.line_id = line[1]
        #: Parts that follow a line break start with it, parts that follow a space do not start with that.
        self.cache: dict[str, bytes] = {"\n": np.array(line[1:2], "<u4").tobytes()}

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array, end: int | None = None) -> list[np.ndarray]:
        """The ids of every text, a null one being empty, and after them ``end`` if it is given."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, self._odd).to_numpy(zero_copy_only=False)
        tail = np.zeros(0 if end is None else 1, "<u4") + np.uint32(end or 0)
        out: list = [None] * len(texts)
        at = np.flatnonzero(odd)
        for i in at.tolist():
            out[i] = np.append(np.array(self._whole([texts[i].as_py()])[0], "<u4"), tail).astype("<u4")
        at = np.flatnonzero(~odd)
        if len(at):
            ids, ends = self._parts(texts.take(pa.array(at)))
            # The line break that each text was given in front makes room for the end.
            ids[:-1] = ids[1:]
            ids[ends - 1] = end or 0
            for i, a, b in zip(at.tolist(), [0, *ends[:-1].tolist()], (ends - (end is None)).tolist()):
                out[i] = ids[a:b]
        return out

    def _parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, each with a line break in front, one after another, and where each ends."""
        text = lambda x: pa.scalar(x, pa.large_string())
        texts = pc.replace_substring_regex(texts, self._marks, rf"\1 {_JOIN}\2")
        lists = pc.split_pattern(pc.binary_join_element_wise(text(""), pc.replace_substring(texts, "\n", " \n"), text("\n")), " ")
        parts = lists.flatten().dictionary_encode()
        strings = parts.dictionary.to_numpy(zero_copy_only=False)
        known = list(map(self.cache.get, strings))
        missing = [k for k, x in enumerate(known) if x is None]
        for k in range(0, len(missing), 5000):
            some = missing[k : k + 5000]
            for i, x in zip(some, self._missing([strings[i] for i in some])):
                known[i] = x
                if len(self.cache) < _CACHE_SIZE:
                    self.cache[strings[i]] = x
        sizes = np.fromiter(map(len, known), np.int64, len(known)) >> 2
        ids, ends = gather(np.frombuffer(b"".join(known), "<u4"), sizes, parts.indices.to_numpy())
        return ids, ends[np.asarray(lists.offsets)[1:] - np.asarray(lists.offsets)[0] - 1]

    def _missing(self, parts: list[str]) -> list[bytes]:
        """Ids of each part, from one call over all of them on lines of their own."""
        lines = [p[1:] if p[0] in _STARTS else " " + p for p in parts]
        ids = np.array(self._whole(["\n".join(lines)])[0], "<u4")
        at = np.flatnonzero(ids == self.line_id)
        if len(at) != len(parts) - 1:
            return [np.array(x, "<u4").tobytes() for x in self._whole(["\n" + t if p[0] == "\n" else t for p, t in zip(parts, lines)])]
        raw, line = ids.tobytes(), np.array([self.line_id], "<u4").tobytes()
        starts, ends = [0, *(at * 4 + 4).tolist()], [*(at * 4).tolist(), len(raw)]
        return [line + raw[a:b] if p[0] == "\n" else raw[a:b] for p, a, b in zip(parts, starts, ends)]


@lru_cache(maxsize=1)
def encoder_of(file: str) -> CachedEncoder:
    """The encoder that a worker keeps from task to task, with what its cache holds."""
    return CachedEncoder(file)


def write_tokens(docs: DataFrame, path: str, encoder: Callable[[], CachedEncoder], end_id: int = 0, percentile: float = 90.0, shard_bytes: int = 32 << 20) -> None:
    """Encode every text, append ``end_id``, and write shard files of ascending, disjoint doc_id ranges to ``path``."""
    plain = pick(docs, "doc_id", "text")
    total = text_bytes(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, rows, size = encoder(), None, [], 0
        for b in batches:
            for doc_ids, texts in slices(b):
                for doc_id, ids in zip(doc_ids.to_pylist(), enc.encode_all(texts, end_id)):
                    if shard is None:
                        shard, rows = ShardWriter(percentile), [MAGIC]
                    for row in shard.add(doc_id, ids):
                        rows.append(row)
                        size += len(row)
                if size >= 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["section"])
                    rows, size = [], 0
        if shard is not None:
            rows += shard.close()
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["section"])

    ranged = plain.repartitionByRange(max(1, -(-total // shard_bytes)), "doc_id").sortWithinPartitions("doc_id")
    # The text writer copies a string's bytes as they are and adds \n, the end of each section.
    ranged.mapInArrow(run, "section binary").select(F.col("section").cast("string").alias("value")).write.text(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(shard_first, doc_id, shard_start, n_tokens, ids_crc32, ids) of all shards below ``path``; ids are
    little-endian unsigned 32-bit integers, or null if they are not asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard_first", "doc_id", "shard_start", "n_tokens", "ids_crc32", "ids"]
        for b in batches:
            for raw in b.column(0):
                shard = Shard(raw.as_py())
                first, rows = int(shard.doc_ids[0]) if len(shard.doc_ids) else 0, []
                for doc_id, start, ids in shard.documents():
                    blob = ids.astype("<u4").tobytes()
                    rows.append((first, doc_id, start, len(ids), zlib.crc32(blob), blob if with_ids else None))
                    if len(rows) == 2000:
                        yield _batch(names, rows)
                        rows = []
                yield _batch(names, rows)

    def _batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 5 + [pa.binary()])], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.where(F.col("length") > 0).select("content").mapInArrow(run, "shard_first long, doc_id long, shard_start long, n_tokens long, ids_crc32 long, ids binary")


def token_output(docs: DataFrame, tokenizer_file: str, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Write the ids of all documents and read them back: (doc_id, start, n_tokens, ids_crc32), a row per document.

    start counts the ids of all documents before this one in ascending doc_id order; n_tokens includes the end id. A
    null or empty text is the end id alone. Rows that repeat a doc_id follow each other in any order. Other columns
    are ignored. An empty table gives no rows.
    """
    path = path or scratch_dir(docs.sparkSession)
    write_tokens(docs, path, lambda: encoder_of(tokenizer_file), end_id)
    # One short row per document; the ids themselves stay in the shard files.
    rows = materialize(read_tokens(docs.sparkSession, path, with_ids=False).drop("ids"))
    # A row per shard: as many as files, so one task may order them.
    shards = rows.groupBy("shard_first").agg(F.sum("n_tokens").alias("n"))
    before = shards.select("shard_first", (F.sum("n").over(Window.orderBy("shard_first")) - F.col("n")).alias("before"))
    return rows.join(before, "shard_first").select("doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")
