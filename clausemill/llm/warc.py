"""WARC archives of captured pages, and a globally ordered capture index over them.

Archives are written through Spark's file committer, a record per row and a gzip member per record, so the files are
plain WARC/1.1 and a reader can seek to any record. The row's separator is a member's last byte, the high byte of its
inflated size: zero, but for records of 16 MB and more, which an empty member follows. Reading parses by lengths.

Index method: external merge. The captures of one archive, sorted by URL key and timestamp, are a run; a range
partitioning cuts the runs into key ranges; each range's run pieces are merged by a loser tree. Ranges in order
make up the ordered capture histories. URL, timestamp and id together order the captures, so that a URL with a third of
all captures is spread over many ranges.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, pick, scratch_dir

MIN_REVISIT_BYTES = 100
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = re.compile(rb"<urn:page:(-?\d+)>")
_EMPTY_MEMBER = zlib.compressobj(wbits=31).flush()


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def _date(page_id: Column, first: str) -> Column:
    """Where no capture time is given: one second per id, from ``first`` on, over and over in a thousand years."""
    second = F.unix_timestamp(F.lit(first).cast("timestamp")) + F.pmod(page_id, F.lit(31_536_000_000))
    return F.date_format(second.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _header(*fields: tuple[str, Column]) -> Column:
    return F.concat_ws("\r\n", F.lit("WARC/1.1"), *[F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v.cast("string"))) for k, v in fields])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record as a gzip member that ends with a zero byte, without that byte."""
    for b in batches:
        out = []
        for record in b.column(0):
            deflate = zlib.compressobj(wbits=31)
            member = deflate.compress(record.as_py()) + deflate.flush()
            out.append((member if member.endswith(b"\0") else member + _EMPTY_MEMBER)[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write_warc(pages: DataFrame, path: str, first_date: str = "2024-01-01 00:00:00", file_bytes: int = 32 << 20) -> None:
    """Archives of ``pages`` (page_id, url, html) in ``path``. Of the pages with equal payloads of at least
    MIN_REVISIT_BYTES, the one of least page_id is a response and the others are revisits of it."""
    payload = F.coalesce("html", F.lit(""))
    plain = pick(pages, "page_id", "url", "html").withColumn("digest", F.sha2(payload, 256))
    keys = plain.select("page_id", "digest", F.octet_length(payload).alias("size"))
    # Only digests and ids are dealt by digest; a hot payload costs a map-side minimum and a split join.
    least = keys.where(F.col("size") >= MIN_REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "refers_to")
    revisits = keys.select("page_id", "digest").join(least.hint("merge"), "digest").where("page_id != refers_to").dropDuplicates(["page_id", "digest"])
    total = keys.agg(F.sum("size")).first()[0] or 0
    # The payloads move once. Revisits grow with the corpus: a merge join at every size.
    dealt = plain.repartition(max(1, -(-total // file_bytes)), "page_id").join(revisits.hint("merge"), ["page_id", "digest"], "left")
    page = F.col("page_id")
    is_revisit = F.col("refers_to").isNotNull()
    # White space and controls have no place in a header line.
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.concat(F.lit("urn:page:"), page.cast("string")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(is_revisit, F.lit("")).otherwise(payload))
    header = _header(
        ("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", _record_id(page)),
        ("WARC-Date", _date(page, first_date)),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Profile", F.when(is_revisit, F.lit(_REVISIT))),
        ("WARC-Refers-To", F.when(is_revisit, _record_id(F.col("refers_to")))),
        ("WARC-Refers-To-Date", F.when(is_revisit, _date(F.col("refers_to"), first_date))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length(block)),
    )
    records = dealt.select(F.concat(header, F.lit("\r\n\r\n"), block, F.lit("\r\n\r\n")).cast("binary").alias("value"))
    records.mapInArrow(_members, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


def url_key(uri: str) -> str:
    """Host labels reversed, then path and query: captures of a site, and of a page, sort together."""
    rest = re.sub(r"^[a-z][a-z0-9+.-]*://", "", uri.split("#", 1)[0].lower())
    host, slash, path = rest.partition("/")
    host = host.rpartition("@")[2].partition(":")[0]
    return ",".join(reversed(host.removeprefix("www.").split("."))) + ")" + slash + path


class _Stream:
    """A gzip file's bytes, a few at a time; ``member`` is where the member read last begins."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.have, self.member = memoryview(raw), 0, bytearray(), 0
        self.inflate = zlib.decompressobj(31)

    def fill(self) -> bool:
        if self.inflate.eof:
            self.at -= len(self.inflate.unused_data)
            if self.at < len(self.raw):
                self.member, self.inflate = self.at, zlib.decompressobj(31)
        if self.at >= len(self.raw):
            return False
        piece = self.raw[self.at : self.at + 16384]
        self.have += self.inflate.decompress(piece)
        self.at += len(piece)
        return True

    def until(self, end: bytes) -> bytes | None:
        while (k := self.have.find(end)) < 0:
            if not self.fill():
                return None
        return self.take(k + len(end))

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self.fill():
                raise ValueError("a record is cut short")
        out = bytes(self.have[:n])
        del self.have[:n]
        return out


def parse(raw: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes, int]]:
    """Header fields and block of every record of an archive, and where in the file the gzip member begins that holds
    its first byte."""
    s = _Stream(raw)
    while True:
        while not s.have and s.fill():
            pass
        offset = s.member
        head = s.until(b"\r\n\r\n")
        if head is None:
            if s.have or not s.inflate.eof:
                raise ValueError("an archive ends within a record")
            return
        version, *lines = head[:-4].split(b"\r\n")
        if not version.startswith(b"WARC/1."):
            raise ValueError("not a WARC record")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines)}
        block = s.take(int(fields[b"content-length"]))
        if s.take(4) != b"\r\n\r\n":
            raise ValueError("a record's length is wrong")
        yield fields, block, offset


_CAPTURE = pa.schema([("run", pa.string()), ("seq", pa.int64()), ("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("record_offset", pa.int64())])
_CAPTURE_DDL = "run string, seq long, url_key string, captured string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, record_offset long"


def _page_of(value: bytes | None) -> int | None:
    m = _ID.fullmatch(value or b"")
    return int(m[1]) if m else None


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """A row for each capture of the archives in ``path``, sorted within its archive, which is its ``run``. A
    response's digest is computed from its payload and must be the stated one; a revisit's size and digest are those
    of the payload that its headers state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, raw in zip(b.column(0), b.column(1)):
                rows = []
                for fields, block, offset in parse(raw.as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    stated = fields[b"warc-payload-digest"].removeprefix(b"sha256:").decode()
                    kind = fields[b"warc-type"].decode()
                    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
                    if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, stated):
                        raise ValueError(f"a payload of {name} does not have its digest")
                    uri = fields[b"warc-target-uri"].decode()
                    captured = re.sub(r"\D", "", fields[b"warc-date"].decode())
                    rows.append((url_key(uri), captured, _page_of(fields[b"warc-record-id"]), uri, kind, size, stated, _page_of(fields.get(b"warc-refers-to")), offset))
                rows.sort(key=lambda r: r[:3])
                cols = [[name.as_py()] * len(rows), range(len(rows)), *(zip(*rows) if rows else [()] * 9)]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _CAPTURE)], schema=_CAPTURE)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.where("length > 0").select("path", "content").mapInArrow(run, _CAPTURE_DDL)


class LoserTree:
    """Merges sorted lists: inner nodes hold the losers of their matches, so a new head meets only those on its way
    up."""

    def __init__(self, runs: list[list]):
        self.runs, self.at, n = runs, [0] * len(runs), max(1, len(runs))
        self.size = 1 << (n - 1).bit_length()
        self.losers = [0] * self.size
        winners = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (b, a) if self._before(b, a) else (a, b)
        self.winner = winners[1]

    def _head(self, k: int):
        return self.runs[k][self.at[k]] if k < len(self.runs) and self.at[k] < len(self.runs[k]) else None

    def _before(self, a: int, b: int) -> bool:
        x, y = self._head(a), self._head(b)
        return x is not None and (y is None or x < y or (x == y and a < b))

    def __iter__(self) -> Iterator:
        while (head := self._head(self.winner)) is not None:
            yield head
            k = self.winner
            self.at[k] += 1
            node = (k + self.size) // 2
            while node:
                if self._before(self.losers[node], k):
                    k, self.losers[node] = self.losers[node], k
                node //= 2
            self.winner = k


def merge_index(runs: DataFrame, per_range: int = 50_000) -> DataFrame:
    """The captures with capture_no, their place in the global order of URL key, timestamp and id. Spark's range
    partitioner deals them into ranges of about ``per_range`` captures; its sample grows with their number."""
    ranges = max(1, -(-runs.count() // per_range))
    keys = ["url_key", "captured", "page_id"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), _CAPTURE)
        no_id = -(1 << 63)
        heads = list(zip(*(table.column(c).to_pylist() for c in keys[:2]), [no_id if p is None else p for p in table.column("page_id").to_pylist()], range(table.num_rows)))
        run = np.array(table.column("run").to_pylist(), dtype=object)
        cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(heads)]
        order = [h[-1] for h in LoserTree([heads[a:b] for a, b in zip(cuts, cuts[1:])])]
        out = table.take(pa.array(order, pa.int64())).append_column("index_pos", pa.array(range(len(order)), pa.int64()))
        place = pa.array([TaskContext.get().partitionId()] * len(order), pa.int32())
        yield from out.append_column("index_range", place).to_batches()

    # A range's captures of one archive follow each other in their order: a piece of a sorted run.
    dealt = runs.repartitionByRange(ranges, *keys).sortWithinPartitions("run", "seq")
    merged = materialize(dealt.mapInArrow(merge, f"{_CAPTURE_DDL}, index_pos long, index_range int"))
    # A row per range, some ten thousands of captures each: one task may order them.
    sizes = merged.groupBy("index_range").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("index_range", (F.sum("n").over(Window.orderBy("index_range")) - F.col("n")).alias("before"))
    return merged.join(before, "index_range").withColumn("capture_no", F.col("before") + F.col("index_pos")).drop("before")


def archive(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC archives, read them back and index them: a row per page with
    page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, captured, capture_no, its place in the global
    index, and archive and record_offset, the file that holds it and where in the file its record's gzip member begins.

    A null html is an empty payload; payloads under 100 bytes are always responses; a null url becomes urn:page:ID.
    Rows with a null page_id are left out. Rows that repeat a page_id are captured each. Other columns are ignored. An
    empty table gives no rows. Memory follows the longest payload and a file's captures.
    """
    path = path or scratch_dir(pages.sparkSession)
    write_warc(pages, path)
    runs = materialize(read_runs(pages.sparkSession, path))
    return merge_index(runs).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "capture_no", F.col("run").alias("archive"), "record_offset")
