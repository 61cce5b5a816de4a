"""Registered queries read their whole input: long documents and every order, against brute force."""

from __future__ import annotations

from collections import Counter

import pytest

from clausemill import queries

LONG, SHORT = 150, 3


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two documents, of LONG and SHORT lines, and 200 orders of one line each."""
    path = str(tmp_path_factory.mktemp("whole"))
    docs = [(d, "\n".join(f"line {d} {i} of the text" for i in range(n)), "en", "a", 0) for d, n in ((0, LONG), (1, SHORT))]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    items = [(o, 1, o % 9, o % 5, 3.0, "N", 10.0, "1995-01-01") for o in range(200)]
    spark.createDataFrame(items, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string, l_extendedprice double, l_shipdate string").write.parquet(f"{path}/lineitem.parquet")
    return path


def run(spark, folder, name):
    return queries.QUERIES[name](spark, folder).collect()


def test_units_hold_every_paragraph(spark, folder):
    rows = run(spark, folder, "u05_u10_paragraph_units")
    n = sum(len(r.text.split("\n\n")) for r in rows if r.doc_id == 0)
    assert n == LONG


@pytest.mark.parametrize("name", ["t07_captions", "t08_nearby_notes", "t09_auto_ids", "t10_nearest_paragraph"])
def test_every_table_element_is_judged(spark, folder, name):
    got = {(r.doc_id, r.dom_idx) for r in run(spark, folder, name)}
    assert got == {(0, i * 9) for i in range(LONG) if i % 7 == 6}


def test_nearest_paragraph_sees_every_paragraph(spark, folder):
    """A table's nearest paragraph is the element before it, be its number even or odd."""
    got = {r.dom_idx // 9: r.paragraph_index for r in run(spark, folder, "t10_nearest_paragraph")}
    assert got == {i: i - 1 for i in range(LONG) if i % 7 == 6}


def test_every_element_is_aligned(spark, folder):
    got = {(r.doc_id, r.el_idx) for r in run(spark, folder, "c12_align")}
    assert got == {(0, i) for i in range(LONG)} | {(1, i) for i in range(SHORT)}


def test_every_order_is_a_table(spark, folder):
    rows = run(spark, folder, "t05_shapes")
    assert {r.table_idx for r in rows} == set(range(200)) and all((r.n_rows, r.n_cols) == (1, 4) for r in rows)


def test_documents_of_tables_grow_with_the_orders(spark, folder):
    tables = Counter(r.doc_id for r in run(spark, folder, "t05_shapes"))
    assert tables == Counter(o // 15 for o in range(200))
