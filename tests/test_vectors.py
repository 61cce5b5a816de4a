"""The vector index against exact search: clustered, random, tied, odd and few vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from clausemill.operators import vectors as E

DDL = "vec_id long, embedding array<float>, label int, weight int"


def exact(rows, queries, first):
    unit = lambda v: np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float))
    fine = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    out = {}
    for q, v in queries:
        if fine(v):
            scored = sorted((-round(float(unit(v) @ unit(x)), 6), i) for i, x, *_ in rows if fine(x))
            for nth, (s, i) in enumerate(scored[:first], 1):
                out[q, nth] = (i, -s + 0.0)
    return out


def found(spark, rows, queries, first, **kw):
    index = E.build_index(spark.createDataFrame(rows, DDL).repartition(3), **kw)
    got = E.nearest(index, spark.createDataFrame(queries, "qid long, query array<float>"), first).collect()
    return {(r.qid, r.nth): (r.vec_id, round(r.score, 6)) for r in got}


@pytest.mark.parametrize("kind", ["clusters", "random", "ties"])
def test_equals_exact_search(spark, monkeypatch, kind):
    monkeypatch.setattr(E, "BLOCK", 40)
    r = np.random.default_rng(1)
    x = r.standard_normal((400, 6))
    if kind == "clusters":
        x = np.repeat(r.standard_normal((8, 6)) * 5, 50, axis=0) + 0.1 * x
    if kind == "ties":
        x = np.round(x)
    x = x.astype(np.float32)
    rows = [(i, v.tolist(), i % 4, i % 3) for i, v in enumerate(x)] + [(900, None, 0, 0), (901, [0.0] * 6, 0, 0), (902, [math.nan] * 6, 0, 0), (903, [math.inf] * 6, 0, 0)]
    queries = [(i, v) for i, v, *_ in rows if i % 20 == 0] + [(5000, [0.0] * 6), (5001, None)]
    for kw in ({}, {"lists": 1}, {"lists": 50}):
        assert found(spark, rows, queries, 7, **kw) == exact(rows, queries, 7)


def test_bounds_leave_lists_unread(spark):
    r = np.random.default_rng(2)
    x = np.repeat(np.eye(20), 30, axis=0) + 0.01 * r.standard_normal((600, 20))
    rows = [(i, v.tolist(), 0, 0) for i, v in enumerate(x)]
    index = E.build_index(spark.createDataFrame(rows, DDL), lists=20)
    plan = E._plan(index, spark.createDataFrame([(1, [float(v) for v in x[0]])], "qid long, unit array<double>").selectExpr("qid", "transform(unit, v -> v / 1.0) unit"))
    assert plan.count() == len({r["list"] for r in index.lists.collect()})
    assert plan.where("best > 0.9").count() < plan.count() / 2


def test_few_and_no_vectors(spark):
    rows = [(1, [1.0, 0.0], 0, 0), (2, [0.5, 0.5], 0, 0)]
    assert found(spark, rows, [(1, [1.0, 0.0])], 20) == {(1, 1): (1, 1.0), (1, 2): (2, round(0.5**0.5, 6))}
    assert found(spark, [(1, None, 0, 0)], [(1, [1.0, 0.0])], 20) == {}
    assert found(spark, rows, [(1, None)], 20) == {}


def test_weight_counts_by_the_boost(spark):
    rows = [(1, [1.0, 0.0], 0, 0), (2, [1.0, 0.1], 1, 2), (3, [1.0, 0.1], 7, 2)]
    index, q = E.build_index(spark.createDataFrame(rows, DDL)), spark.createDataFrame([(9, [1.0, 0.0])], "qid long, query array<float>")
    ranked = lambda boost: [r.vec_id for r in E.semantic_search(index, q, [0, 1], boost=boost).orderBy("place").collect()]
    assert ranked(0.0) == [1, 2] and ranked(0.05) == [2, 1]
