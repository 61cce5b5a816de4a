r"""Quality rules: per-document counts, and documents depleted by lines that their host repeats.

Method: hash normalised lines, count distinct documents per host and line, remove lines above the limit, reject
documents that keep too few of their words.

Copies of one document are near-dedup's work and must not turn its lines into boilerplate. So the documents that the
count would reject are grouped by near-dedup, over whole documents, and each line is counted again with a group as one
document. Nothing near a line is looked at: the inner lines of a fixed template count like any others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, Words, ascii_lower, hash128, materialize, pick, slices, window_hashes
from .minhash_dedup import near_duplicates

SYMBOLS = "#*$%&|<>"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_METRICS = ", ".join(f"{c} long" for c in ["doc_id", "text_hash", *_COUNTS])


def _repeat_words(w: Words) -> np.ndarray:
    """For each text: words inside 3-word windows that occur at least twice in it."""
    n = len(w.hash)
    out = np.zeros(len(w.first) - 1, dtype=np.int64)
    if n < 3:
        return out
    owner = w.owner()
    grams = window_hashes(w.hash, 3)
    inside = owner[:-2] == owner[2:]
    keys = grams ^ (owner[:-2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(inside)
    order = at[np.argsort(keys[at], kind="stable")]
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(n, dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = again.copy()
    covered[1:] |= again[:-1]
    covered[2:] |= again[:-2]
    np.add.at(out, owner[covered], 1)
    return out


def _metrics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for both, texts in (x for b in batches for x in slices(b, 1 << 20)):
        yield _metrics_of(both.field(0), both.field(1), [x or b"" for x in texts.cast(pa.large_binary()).to_pylist()])


def _metrics_of(ids: pa.Array, hashes: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
    w = Words(texts)
    repeat = _repeat_words(w)
    chars, symbols, dups = [], [], []
    for t in texts:
        s = t.decode()
        chars.append(len(s) - sum(s.count(c) for c in SPACES))
        symbols.append(sum(s.count(c) for c in SYMBOLS))
        lines = t.split(b"\n")
        dups.append(sum(n - 1 for x, n in Counter(lines).items() if n > 1 and x.split(None, 1)) if len(lines) > 1 else 0)
    cols = [ids, hashes, *(pa.array(np.asarray(c, dtype=np.int64)) for c in (w.counts, chars, symbols, dups, repeat))]
    return pa.RecordBatch.from_arrays(cols, ["doc_id", "text_hash", *_COUNTS])


def document_counts(docs: DataFrame) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every text; all zero for a null text. text_hash
    tells the texts of a repeated doc_id apart."""
    return pick(docs, "doc_id", "text").select(F.struct("doc_id", F.xxhash64("text")).alias("id"), "text").mapInArrow(_metrics, _METRICS)


def _lines(docs: DataFrame, host: str) -> DataFrame:
    """(doc_id, text_hash, pos, k1, k2, words) of every line with words; k1 and k2 hash host and normalised line."""
    rows = (
        pick(docs, "doc_id", "text", host).toDF("doc_id", "text", "host")
        .select("doc_id", F.xxhash64("text").alias("text_hash"), F.xxhash64(F.coalesce(F.col("host").cast("string"), F.lit(""))).alias("host"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
        .withColumn("key", ascii_lower(F.regexp_replace(F.btrim("line", F.lit(SPACES)), r"[\x20\x09-\x0D]+", " ")))
    )
    return rows.select("doc_id", "text_hash", "pos", *hash128("k", "host", "key"), (F.length("key") - F.length(F.translate("key", " ", "")) + 1).alias("words"))


def _repeated_lines(docs: DataFrame, host: str, max_docs: int) -> DataFrame:
    """The lines that more than ``max_docs`` documents of a host hold, once for each place in a different text."""
    lines = _lines(docs, host)
    # Nearly all lines are unique: a count with map-side sums finds the few that need exact distinct counts.
    often = lines.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_docs).select("k1", "k2")
    hits = materialize(lines.join(often, ["k1", "k2"]))
    held = hits.groupBy("k1", "k2").agg(F.count_distinct("doc_id").alias("n")).where(F.col("n") > max_docs).select("k1", "k2")
    return materialize(hits.join(held, ["k1", "k2"]).dropDuplicates(["doc_id", "text_hash", "pos"]))


def _words_of(lines: DataFrame) -> DataFrame:
    return lines.groupBy("doc_id", "text_hash").agg(F.sum("words").cast("long").alias("n_boilerplate"))


def quality_rules(docs: DataFrame, host: str = "source", max_docs: int = 10, min_words: int = 50, max_repeat_percent: int = 50, min_left_percent: int = 30) -> DataFrame:
    """doc_id, the five counts, n_boilerplate, base_failed and kept, a row per document.

    base_failed: fewer than ``min_words`` words, or more than ``max_repeat_percent`` percent of them in repeated
    3-word windows. kept: not base_failed, and at least ``min_left_percent`` percent of the words are left when lines
    that the host repeats in more than ``max_docs`` documents are removed, see the module's text for copies. A null text
    has no words, so it fails; a null host is the host ''. Rows that repeat a doc_id count as one document for each line
    and are each judged by their own text. Other columns are ignored. An empty table gives no rows. Memory follows the
    longest text.
    """
    metrics = document_counts(docs)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    base = materialize(metrics.withColumn("base_failed", failed))
    lines = _repeated_lines(docs, host, max_docs)
    # Verdicts grow with the corpus: merge joins at every size.
    judged = lambda words: base.join(words.hint("merge"), ["doc_id", "text_hash"], "left").withColumn("n_boilerplate", F.coalesce("n_boilerplate", F.lit(0).cast("long"))).withColumn("kept", ~F.col("base_failed") & (100 * (F.col("n_words") - F.col("n_boilerplate")) >= min_left_percent * F.col("n_words")))
    suspects = judged(_words_of(lines)).where("not base_failed and not kept").select("doc_id").distinct()
    copies = materialize(pick(docs, "doc_id", "text").join(suspects.hint("merge"), "doc_id", "left_semi"))
    if copies.isEmpty():
        return judged(_words_of(lines)).select("doc_id", *_COUNTS, "n_boilerplate", "base_failed", "kept")
    groups = near_duplicates(copies, words=5, percent=80).groupBy("doc_id").agg(F.min("component_id").alias("group"))
    counted = lines.join(groups.hint("merge"), "doc_id", "left").groupBy("k1", "k2").agg(F.count_distinct(F.coalesce("group", "doc_id")).alias("n"))
    bad = materialize(counted.where(F.col("n") > max_docs).select("k1", "k2"))
    return judged(_words_of(lines.join(bad, ["k1", "k2"]))).select("doc_id", *_COUNTS, "n_boilerplate", "base_failed", "kept")
