"""Line dedup: drop lines that many documents share.

Method: explode normalised lines, hash them, count distinct documents per hash, drop lines over the threshold and
reassemble by position. Only hashes are shuffled for the count; the text moves once, to meet its dropped positions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, free_name, hash128, materialize, pick

_TRIM = r"trim(BOTH ' \t\n\u000b\f\r' FROM line)"
_ROW = ("doc_id", "text_hash1", "text_hash2")
#: Columns that ``drop_lines`` adds for a while.
_ADDED = ("text_hash1", "text_hash2", "drop")


def _with_hash(docs: DataFrame) -> DataFrame:
    """A text's dropped positions follow from the text, so rows that repeat a doc_id are told apart by its hash."""
    return docs.select("*", *hash128("text_hash", F.coalesce("text", F.lit(""))))


def lines_of(docs: DataFrame) -> DataFrame:
    r"""(doc_id, text_hash1, text_hash2, pos, line, key): every text split at \n; a null or empty text is one empty line.
    The key is the line without ASCII white space at its ends and with A-Z lower-cased."""
    return (
        _with_hash(pick(docs, "doc_id", "text"))
        .select(*_ROW, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
        .withColumn("key", ascii_lower(F.expr(_TRIM)))
    )


def frequent_positions(docs: DataFrame, min_docs: int, min_chars: int = 1) -> DataFrame:
    """(doc_id, text_hash1, text_hash2, drop: array of line positions) for texts that hold a key of at least
    ``min_chars`` code points found under at least ``min_docs`` different doc_ids."""
    keyed = lines_of(docs).where(F.length("key") >= min_chars).select(*_ROW, "pos", *hash128("k", "key"))
    # A row counts once per key: repeats inside a text go before the shuffle.
    once = (
        pick(docs, "doc_id", "text")
        .select(F.explode(F.array_distinct(F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: ascii_lower(F.btrim(x, F.lit(" \t\n\x0b\x0c\r")))))).alias("key"))
        .where(F.length("key") >= min_chars)
        .select(*hash128("k", "key"))
    )
    # Rows are at least as many as doc_ids: their count, with map-side sums, leaves few keys for exact distinct counts.
    often = once.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("k1", "k2")
    # AQE broadcasts the frequent keys where they are few and splits the skewed side of the join where they are not.
    hits = materialize(keyed.join(often, ["k1", "k2"]))
    frequent = hits.groupBy("k1", "k2").agg(F.count_distinct("doc_id").alias("n")).where(F.col("n") >= min_docs).select("k1", "k2")
    return hits.join(frequent, ["k1", "k2"]).groupBy(*_ROW).agg(F.collect_set("pos").alias("drop"))


def _kept(text: str | None, drop: pa.Scalar) -> tuple[str, int, int]:
    lines = (text or "").split("\n")
    if not drop.is_valid:
        return text or "", len(lines), 0
    gone = np.zeros(len(lines), dtype=bool)
    gone[drop.values.to_numpy()] = True
    return "\n".join([x for x, g in zip(lines, gone.tolist()) if not g]), len(lines), int(gone.sum())


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [_kept(t.as_py(), d) for t, d in zip(b.column("text"), b.column("drop"))]
        texts, n_lines, n_dropped = zip(*rows) if rows else ((), (), ())
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "kept_text", "n_lines", "n_dropped", "kept_sha256"])


def _with_drops(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    # Dropped positions grow with the corpus: always a merge join, whatever their size here.
    return _with_hash(docs).join(materialize(frequent_positions(docs, min_docs, min_chars)).hint("merge"), list(_ROW), "left")


def drop_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with the kept text in place of text and, if there is such a column, its length as n_chars. See
    ``line_dedup`` for the rule. Other columns, of any names, stay as they are; rows without a doc_id are left out."""
    names, schema = docs.columns, docs.schema
    clash = {n: free_name([*names, *_ADDED], n + "_") for n in names if n.lower() in _ADDED}
    docs = docs.withColumnsRenamed(clash)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [_kept(t.as_py(), d)[0] for t, d in zip(b.column("text"), b.column("drop"))]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "text" else b.column(clash.get(n, n)) for n in names], names)

    out = _with_drops(docs.where("doc_id is not null"), min_docs, min_chars).mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in names else out


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(doc_id, kept_text, n_lines, n_dropped, kept_sha256), a row per row of ``docs``.

    ``docs`` has doc_id and text. Rows that repeat a doc_id count as one document for each line they hold, and each is
    cut by its own text. A null or empty text is one empty line; an empty key is never dropped;
    a document all of whose lines go keeps the empty text. Other columns are ignored. An empty table gives no rows.
    """
    return _with_drops(pick(docs, "doc_id", "text"), min_docs, min_chars).mapInArrow(_rebuild, "doc_id long, kept_text string, n_lines long, n_dropped long, kept_sha256 string")
