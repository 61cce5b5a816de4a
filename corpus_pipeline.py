"""Corpus pipeline: raw documents to filtered, deduplicated, decontaminated and tokenised documents.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.
Rows without a doc_id leave at the first stage; an empty table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clausemill.llm.common import arrow_batches, materialize, scratch_dir, scratch_folder
from clausemill.llm.decontaminate import find_items
from clausemill.llm.line_dedup import drop_lines
from clausemill.llm.minhash_dedup import near_duplicates
from clausemill.llm.quality_rules import quality_rules
from clausemill.llm.sentencepiece_codec import round_trip


def _only(docs: DataFrame, verdict: DataFrame, condition: str) -> DataFrame:
    """The documents for which the verdict holds. Verdicts grow with the corpus: a merge join at every size."""
    return docs.join(verdict.where(condition).select("doc_id").hint("merge"), "doc_id", "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    arrow_batches(spark)
    return _only(docs, quality_rules(docs), "kept")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines found in at least ten documents."""
    arrow_batches(spark)
    return drop_lines(docs, min_docs=10)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of least id, of each group of near duplicates: five-word shingles, similarity 0.8."""
    arrow_batches(spark)
    return _only(docs, near_duplicates(docs, words=5, percent=80), "kept")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, give or take a few edits."""
    arrow_batches(spark)
    return _only(docs, find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "not contaminated")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and what they decode to, as counts and digests."""
    arrow_batches(spark)
    return round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-dedup", near_dups),
    ("decontamination", decontaminate),
    ("sentencepiece", encode),
]

#: Edit distance and piece encoding have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each written to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = scratch_dir(spark)
        with scratch_folder(spark):
            docs = materialize(stage(spark, docs, sf_dir), path)
    return STAGES[-1][1](spark, docs, sf_dir)
