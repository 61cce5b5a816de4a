"""Shared helpers: scratch tables, document bundles and vectorised text hashing.

Bundles are the unit that corpus-wide operators move around: a few MB of whole documents in one row, written once to
the shared scratch folder. An operator sends each bundle's keys, split by hash into *parts*, to the tasks that own
the parts; the answers travel back as small blobs and meet the bundle again in a cogroup on its id. A key that occurs
often is sent once per bundle, so a hot key costs one entry per bundle and never one per occurrence. Bundles and parts
grow with the square root of the corpus, so that a blob for one bundle and part holds many keys at any size.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUNDLE_BYTES = 4 << 20
#: Words are runs of anything but ASCII space and the controls \t \n \v \f \r; ``bytes.split()`` cuts at the same six.
SPACES = " \t\n\x0b\x0c\r"
WORD_RE = r"[^\x20\x09-\x0D]+"
LOWER_FROM, LOWER_TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OWN_DIRS: dict[str, str] = {}
_WRITTEN: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_FOLDER: list[str] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``. Only a session of one machine may leave
    that unset, and then gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = _OWN_DIRS.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="spark-"))
    return f"{_FOLDER[-1] if _FOLDER else base.rstrip('/')}/clausemill-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_folder(spark: SparkSession):
    """Scratch tables made inside go when it ends, so results must have been written elsewhere by then."""
    _FOLDER.append(path := scratch_dir(spark))
    try:
        yield
    finally:
        _FOLDER.remove(path)
        delete(spark, path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage and outlives lost executors. The write's
    shuffle files go when it ends, as nothing reads them again."""
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    with _setting(spark, _CLEANUP, "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    return out


def forget(*written: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once all that read it has been written itself."""
    for df in written:
        delete(df.sparkSession, _WRITTEN.pop(df))


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, LOWER_FROM, LOWER_TO)


def hash128(prefix: str, *cols) -> list:
    """Two independent 64-bit hashes of the columns, as columns ``{prefix}1`` and ``{prefix}2``."""
    return [F.xxhash64(F.lit(1), *cols).alias(f"{prefix}1"), F.xxhash64(F.lit(2), *cols).alias(f"{prefix}2")]


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns of any name cannot clash with helper columns. The first is the
    id, a long; rows without an id have no identity and are left out, by every operator."""
    first, *rest = [F.col(f"`{n}`") for n in names]
    return df.where(first.isNotNull()).select(first.cast("long").alias(names[0]), *rest)


# ---------------------------------------------------------------- vectorised hashing

BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Values that are hashed at once; tables and temporary arrays have about this length.
SLICE = 1 << 18
_LENGTH = np.uint64(0xA24BAED4963EE407)
_POW: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int = SLICE + 1) -> tuple[np.ndarray, np.ndarray]:
    """``n`` powers of an odd base and of its inverse modulo 2**64."""
    if (base, n) not in _POW:
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(n, dtype=np.uint64)
            p[1:] = np.uint64(b)
            both.append(np.multiply.accumulate(p))
        _POW.clear() if len(_POW) > 8 else None
        _POW[base, n] = (both[0], both[1])
    return _POW[base, n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that polynomial values spread over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _running(values: np.ndarray, up: np.ndarray) -> np.ndarray:
    """Sums of (value + 1) * base**place before each place: no value, zero included, is without effect."""
    run = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=run[1:])
    return run


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE_A) -> np.ndarray:
    """A 64-bit hash of each ``values[start:end]``, starts and ends ascending: differences of a running polynomial, moved
    to a common origin, and the length. Works in slices; a longer span is summed piece by piece."""
    up, down = _powers(base)
    out = np.zeros(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = int(np.searchsorted(ends, low + SLICE, side="right"))
        if j > i:
            run = _running(values[low : int(ends[j - 1])], up)
            a, b = starts[i:j] - low, ends[i:j] - low
            out[i:j] = (run[b] - run[a]) * down[a]
        else:
            j, total = i + 1, 0
            for at in range(low, int(ends[i]), SLICE):
                total += int(_running(values[at : min(at + SLICE, int(ends[i]))], up)[-1]) * pow(base, at - low, 1 << 64)
            out[i] = np.uint64(total & (2**64 - 1))
        i = j
    return mix64(out + (ends - starts).astype(np.uint64) * _LENGTH)


def window_hashes(values: np.ndarray, width: int, base: int = BASE_A) -> np.ndarray:
    """Hashes of all windows of ``width`` consecutive values, slice by slice."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    size = max(SLICE, width)
    up, down = _powers(base, size + width)
    out = np.empty(n, dtype=np.uint64)
    for at in range(0, n, size):
        run = _running(values[at : at + size + width - 1], up)
        k = len(run) - width
        out[at : at + k] = mix64((run[width:] - run[:k]) * down[:k])
    return out


def gather(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``flat`` holds one run of values after another, of these sizes: the runs numbered ``which``, one after another, and
    where each ends."""
    starts = np.cumsum(sizes) - sizes
    n = sizes[which]
    ends = np.cumsum(n)
    if not len(which):
        return flat[:0], ends
    return flat[np.arange(ends[-1]) + np.repeat(starts[which] - (ends - n), n)], ends


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of several texts: hashes, byte spans in the joined buffer, and the first word of each text."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        if lower:
            buf = _LOWER[buf]
        space = _IS_SPACE[buf]
        edge = np.diff(space.view(np.int8), prepend=np.int8(1))
        self.starts = np.flatnonzero(edge == -1)
        self.ends = np.flatnonzero(edge == 1)
        self.buf = buf
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_at = np.concatenate([[0], np.cumsum(sizes)])
        #: words of text i are first[i]:first[i+1]
        self.first = np.searchsorted(self.starts, self.text_at)
        self.hash = span_hashes(buf, self.starts, self.ends)

    def second_hash(self) -> np.ndarray:
        """Hashes of the words by another base, so that words with equal ``hash`` still differ."""
        return span_hashes(self.buf, self.starts, self.ends, BASE_B)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


# ---------------------------------------------------------------- bundles

_BUNDLE_SCHEMA = "bundle_id long, kind int, doc_ids binary, sizes binary, texts binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts += [a.dtype.str.ljust(4).encode(), len(a).to_bytes(8, "little"), a.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob, max_output_size=1 << 31)
    out, at = [], 0
    while at < len(raw):
        dtype = np.dtype(raw[at : at + 4].decode().strip())
        n = int.from_bytes(raw[at + 4 : at + 12], "little")
        out.append(np.frombuffer(raw, dtype=dtype, count=n, offset=at + 12))
        at += 12 + n * dtype.itemsize
    return out


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def bundle_bytes(total: int, keys_per_blob: int = 64, bytes_per_key: int = 6) -> int:
    """Size of bundles and parts: with the square root of the corpus, so that a bundle has ``keys_per_blob`` keys for
    each part."""
    return max(BUNDLE_BYTES, int((total * keys_per_blob * bytes_per_key) ** 0.5))


def make_bundles(docs: DataFrame, target: int, kind: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Group documents, as they are read, into rows of about ``target`` bytes of text, and write them to the scratch
    folder. ``docs`` has doc_id and text; a null text is empty. ``kind`` gives each id a small class; a bundle holds
    one class. No shuffle: a bundle is cut from one input task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: dict[int, tuple[list[int], list[bytes]]] = {}
        sizes: dict[int, int] = {}

        def flush(k: int) -> pa.RecordBatch:
            nonlocal seq
            ids, texts = held.pop(k)
            sizes.pop(k)
            seq += 1
            n = np.array([len(t) for t in texts], dtype=np.int64)
            row = [[(part << 32) + seq], [k], [np.array(ids, dtype=np.int64).tobytes()], [n.tobytes()], [zstandard.ZstdCompressor(level=1).compress(b"".join(texts))]]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(row, (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["bundle_id", "kind", "doc_ids", "sizes", "texts"])

        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            kinds = kind(ids) if kind else np.zeros(len(ids), dtype=np.int32)
            text = b.column(1).cast(pa.large_binary())
            for i, k in enumerate(kinds.tolist()):
                t = text[i].as_py() or b""
                own = held.setdefault(k, ([], []))
                own[0].append(int(ids[i]))
                own[1].append(t)
                sizes[k] = sizes.get(k, 0) + len(t) + 64
                if sizes[k] >= target:
                    yield flush(k)
        for k in list(held):
            yield flush(k)

    return materialize(pick(docs, "doc_id", "text").mapInArrow(run, _BUNDLE_SCHEMA))


def bundles_and_parts(docs: DataFrame, kind: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[DataFrame, int]:
    """The bundles of ``docs``, and into how many parts, a power of two, their keys are split."""
    total = text_bytes(docs)
    size = bundle_bytes(total)
    return make_bundles(docs, size, kind), 1 << max(0, total // (2 * size)).bit_length()


def read_bundle(doc_ids: bytes, sizes: bytes, texts: bytes) -> tuple[np.ndarray, list[bytes]]:
    n = np.frombuffer(sizes, dtype=np.int64)
    raw = zstandard.ZstdDecompressor().decompress(texts, max_output_size=max(1, int(n.sum())))
    at = np.concatenate([[0], np.cumsum(n)]).tolist()
    return np.frombuffer(doc_ids, dtype=np.int64), [raw[a:b] for a, b in zip(at, at[1:])]


def arrow_rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)


REQUEST = "part int, bundle_id long, blob binary"
ANSWER = "bundle_id long, part int, blob binary"
REQUEST_ARROW = pa.schema([("part", pa.int32()), ("bundle_id", pa.int64()), ("blob", pa.binary())])


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash, its highest bits; ``parts`` is a power of two."""
    bits = parts.bit_length() - 1
    return hashes >> np.uint64(64 - bits) if bits else np.zeros_like(hashes)


def cuts_by_part(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(part, begin, end) of each part that occurs, ``part`` ascending."""
    at = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    return zip(part[at].tolist(), at.tolist(), [*at[1:].tolist(), len(part)])


def unique_keys(hashes: np.ndarray, parts: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``bits`` bits below the part's of the distinct hashes in order, which of these each hash is, and their parts."""
    unique, inverse = np.unique(hashes, return_inverse=True)
    return (unique << np.uint64(parts.bit_length() - 1)) >> np.uint64(64 - bits), inverse, part_of(unique, parts)


def planes(ascending: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Ascending values of ``size`` bytes as the bytes of their differences, lowest bytes first: high ones compress away."""
    steps = np.diff(ascending, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    return tuple(np.ascontiguousarray(steps[:, k]) for k in range(size))


def joined(bytes_of: list[np.ndarray]) -> np.ndarray:
    """The values of ``planes``."""
    steps = np.zeros((len(bytes_of[0]), 8), dtype=np.uint8)
    for k, b in enumerate(bytes_of):
        steps[:, k] = b
    return np.cumsum(steps.view(np.uint64).ravel())


def requests(bundles: DataFrame, make: Callable[[np.ndarray, list[bytes]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Rows (part, bundle_id, blob) from ``make(doc_ids, texts)`` of each bundle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, texts = read_bundle(r["doc_ids"], r["sizes"], r["texts"])
                rows = [(p, r["bundle_id"], blob) for p, blob in make(ids, texts)]
                yield from arrow_rows(REQUEST_ARROW, rows).to_batches()

    return bundles.select("bundle_id", "doc_ids", "sizes", "texts").mapInArrow(run, REQUEST)


def answer_parts(asked: DataFrame, answer: Callable[[list[int], list[bytes]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """For each part, ``answer(bundle_ids, blobs)`` gives (bundle_id, blob) rows."""
    schema = pa.schema([("bundle_id", pa.int64()), ("part", pa.int32()), ("blob", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = [(b, part, blob) for b, blob in answer(table.column("bundle_id").to_pylist(), table.column("blob").to_pylist())]
        return arrow_rows(schema, rows)

    return asked.groupBy("part").applyInArrow(run, ANSWER)


def meet(bundles: DataFrame, answers: DataFrame, use: Callable[[int, np.ndarray, list[bytes], dict[int, bytes]], list[tuple]], schema: pa.Schema, ddl: str) -> DataFrame:
    """Bring each bundle together with its answers; ``use(bundle_id, doc_ids, texts, {part: blob})`` gives rows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = dict(zip(right.column("part").to_pylist(), right.column("blob").to_pylist()))
        rows = []
        for r in left.to_pylist():
            ids, texts = read_bundle(r["doc_ids"], r["sizes"], r["texts"])
            rows += use(r["bundle_id"], ids, texts, got)
        return arrow_rows(schema, rows)

    return bundles.groupBy("bundle_id").cogroup(answers.groupBy("bundle_id")).applyInArrow(run, ddl)


def slices(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of a batch (id, text), as stretches of about ``size`` bytes of text."""
    ends = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.float64)))
    at = 0
    while at < len(ends):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size)) + 1
        yield batch.column(0)[at:stop], batch.column(1)[at:stop]
        at = stop
    # Workers outlive their stage: what Arrow has in hand goes back.
    pa.default_memory_pool().release_unused()


def free_name(taken: list[str], name: str) -> str:
    """``name``, or that with underscores until no column has it."""
    while name.lower() in {x.lower() for x in taken}:
        name += "_"
    return name


def arrow_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bound what one Arrow batch holds, so that long texts do not fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
