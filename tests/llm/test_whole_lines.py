"""Line dedup on tables that repeat rows and ids."""

from __future__ import annotations

from clausemill.llm.line_dedup import drop_lines, line_dedup


def test_repeated_rows_are_one_document(spark):
    rows = [(i, f"shared\nown {i}") for i in range(5)] * 2 + [(100 + i, f"often\nown {i} too") for i in range(10)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((i, t.removeprefix("often\n")) for i, t in rows)
    assert sorted((r.doc_id, r.kept_text) for r in line_dedup(table).collect()) == want
    assert sorted((r.doc_id, r.text) for r in drop_lines(table).collect()) == want


def test_rows_of_one_id_keep_their_own_drops(spark):
    rows = [(i, f"often\nown {i}") for i in range(10)] + [(3, "a\nb\nc\nd\noften"), (3, "alone"), (3, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted([(i, f"own {i}", 1) for i in range(10)] + [(3, "a\nb\nc\nd", 1), (3, "alone", 0), (3, "", 0)])
    assert sorted((r.doc_id, r.kept_text, r.n_dropped) for r in line_dedup(table).collect()) == want
