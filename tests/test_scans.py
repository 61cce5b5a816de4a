"""Two-level scans: the same rows with chunks of any length, and no window over a whole long document."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from clausemill.functions.variations import attach_continuations
from clausemill.operators.clauses import clauses, delete_and_merge, headings, segments
from clausemill.operators.scans import running
from clausemill.plans.units import content_segments
from clausemill.sources import fixtures as X
from tests.test_queries import DATA


def test_sums_and_carried_values(spark):
    r = random.Random(1)
    rows = [(d, i, r.choice([None, 0, 1, 5])) for d, n in ((1, 100), (2, 7), (3, 31), (4, 1)) for i in range(n) if r.random() < 0.9] + [(9, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, i int, v int").repartition(3)
    want, total, last = [], {}, {}
    for d, i, v in sorted(x for x in rows if x[1] is not None):
        if v is not None:
            total[d], last[d] = total.get(d, 0) + v, v
        want.append((d, i, total.get(d), last.get(d)))
    for chunk in (1, 2, 10, 1000):
        got = running(df, "i", sums={"s": F.coalesce("v", F.lit(0))}, lasts={"l": F.col("v")}, chunk=chunk)
        assert sorted(tuple(x) for x in got.select("doc_id", "i", "s", "l").collect()) == [(d, i, s or 0, l) for d, i, s, l in want]


@pytest.mark.parametrize("job", [
    lambda p, c: segments(p, c),
    lambda p, c: clauses(p, c),
    lambda p, c: delete_and_merge(headings(p).withColumnRenamed("clause_text", "text"), F.expr("para_idx % 3 = 1"), c),
    lambda p, c: attach_continuations(p.withColumn("text", F.expr("case when para_idx % 4 = 1 then concat('NSW H4D', 1 + para_idx, ' ', text) else text end")), c),
    lambda p, c: content_segments(p.selectExpr("doc_id", "para_idx idx", "'p' tag", "case when para_idx % 3 = 1 then concat('C2D', 1 + para_idx, ' ', text) else text end text"), c),
])
def test_operators_do_not_depend_on_chunks(spark, job):
    p = X.clause_paragraphs(spark, DATA).where("doc_id % 5 = 0")
    rows = lambda c: sorted(map(repr, job(p, c).collect()))
    want = rows(1 << 17)
    assert len(want) > 10 and rows(3) == want


def test_short_documents_are_read_and_dealt_once(spark):
    rows = spark.createDataFrame([(d, i, f"t{i}") for d in range(3) for i in range(5)], "doc_id long, para_idx int, text string")
    plan = lambda chunk: running(rows, "para_idx", sums={"n": F.length("text")}, chunk=chunk)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan(2) and "Union" not in plan(5) and "Join" not in plan(5)


def test_contexts_do_not_carry_the_text(spark):
    from clausemill import queries

    plan = queries.QUERIES["v30_context"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window") :].splitlines()[1]
    assert "Union" not in plan and re.search(r"Project \[doc_id#\d+L, para_idx#\d+, CASE", below)


def test_headings_are_looked_for_before_exclusions(spark):
    """Most lines are no headings; they are read by one pattern and not stripped."""
    from clausemill.operators import clauses as C

    texts = ["2.6.3 Fire", " Table 2", "tab. 3", "Figure 1", "page 12 x", "5 mm", "5 mmx", "5.5 kg", "1.2 V of it", "E2.2a x", "1.2", "ab", "\u0085", " 12.5 A \n", "TAB\t4"]
    want = [False, True, True, True, True, True, False, True, True, False, False, True, True, True, True]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(C.is_excluded(F.col("text"))).collect()] == want
    plan = df.where(C.is_heading(F.col("text")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RLIKE(text") < plan.index("trim(") and plan.count("trim(") == 3
