"""Short benchmark items are found by the registered query and by the pipeline."""

from __future__ import annotations

import corpus_pipeline
from clausemill.llm.queries import op10_decontaminate


def test_short_items_are_found(spark, tmp_path):
    docs = [(1, "so they ask What is  the\nboiling point and go"), (2, "what is the boilng point"), (3, "nothing here"), (4, "say zq9 now"), (5, "zq 9")]
    items = [(7, "What is the boiling point"), (8, "zq9"), (9, " \n"), (10, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: (r.item_ids, r.distances) for r in op10_decontaminate(spark, str(tmp_path)).collect()}
    assert got == {1: ([7], [0]), 2: ([7], [1]), 3: ([], []), 4: ([8], [0]), 5: ([], [])}
    left = corpus_pipeline.decontaminate(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {r.doc_id for r in left.collect()} == {3, 5}
