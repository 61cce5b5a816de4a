"""Incremental arrival: whole documents land as files, and each micro-batch runs the batch functions unchanged.

Segmentation needs a document's paragraphs together and nothing else, so a document is the unit of arrival and no state
is kept between batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clausemill.operators.clauses import clauses


def stream_clauses(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Reads Parquet files of (doc_id, text) as they arrive in ``source``; appends their clauses to ``target``, by batch,
    so that a batch that is run again replaces what it had written."""

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("para_idx", "text"))
        clauses(lines).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    docs = spark.readStream.schema("doc_id long, text string").parquet(source)
    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
