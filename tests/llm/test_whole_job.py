"""Cases in which an operator did less than its whole job."""

from __future__ import annotations

import random

import pytest

from clausemill.llm.line_dedup import drop_lines
from clausemill.llm.quality_rules import quality_rules

SCHEMA = "doc_id long, text string, source string"


def sayer(seed: int):
    r = random.Random(seed)
    return lambda n: " ".join("w%d" % r.randrange(10**6) for _ in range(n))


@pytest.mark.parametrize("at_end", [False, True])
def test_quality_rules_reject_a_fixed_template_of_several_lines(spark, at_end):
    say = sayer(3)
    menu = [say(10) for _ in range(5)]
    rows = [(i, "\n".join([say(20), *menu] if at_end else [*menu, say(20)]), "a") for i in range(40)]
    rows += [(100 + i, "\n".join([*menu, say(200)]), "a") for i in range(20)]
    elsewhere = [(200 + i, "\n".join([*menu, say(20)]), "b") for i in range(10)]
    body = say(120)
    copies = [(300 + i, "\n".join([body, say(60)[:3] + str(i)]), "a") for i in range(40)]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows + elsewhere + copies, SCHEMA)).collect()}
    assert all(got[i].n_boilerplate == 50 and got[i].kept == (i >= 100) for i, _, _ in rows)
    assert all(got[i].n_boilerplate == 0 and got[i].kept for i, _, _ in elsewhere + copies)


def test_quality_rules_with_repeated_rows(spark):
    say = sayer(5)
    menu = say(40)
    rows = [(i, menu + "\n" + say(30), "a") for i in range(12)]
    rows += [rows[0], (0, say(60), "a"), (1, menu + "\n" + say(100), "a")]
    got = sorted((r.doc_id, r.n_words, r.n_boilerplate, r.kept) for r in quality_rules(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == sorted((d, len(t.split()), 40 if menu in t else 0, len(t.split()) in (60, 70, 140)) for d, t, _ in rows)


def test_line_drop_keeps_columns_of_any_name(spark):
    rows = [(i, f"same line\nown {i}", "x", i, "y") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, drop string, Text_Hash1 long, text_hash2 string")
    out = drop_lines(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(i, f"own {i}", "x", i, "y") for i in range(10)]
