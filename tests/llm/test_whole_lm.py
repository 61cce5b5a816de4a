"""Language-model scores: held-out documents are scored and tune nothing."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from clausemill.llm import lm_scoring
from tests.llm.test_operators import LOWER, WORD, by_id, docs, texts  # noqa: F401


def score(spark, rows):
    return by_id(lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string")))


def test_held_out_texts_do_not_move_other_scores(spark):
    rows = list(texts().items())
    held = set(np.array([i for i, _ in rows])[lm_scoring.in_fold(np.array([i for i, _ in rows])).astype(bool)].tolist())
    one, two = score(spark, rows), score(spark, [(i, "other words " * 50 if i in held else t) for i, t in rows])
    assert held and all(two[i]["score"] == pytest.approx(g["score"], rel=1e-12) for i, g in one.items() if i not in held)


def test_weights_come_from_deleted_counts(docs):  # noqa: F811
    tokens = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in texts().items()}
    pairs = {i: list(zip(["start", *d[:-1]], d)) for i, d in tokens.items()}
    pairs = {i: [((k == 0) or a, b) for k, (a, b) in enumerate(p)] for i, p in pairs.items()}
    held = {i: bool(lm_scoring.in_fold(np.array([i]))[0]) for i in tokens}
    train = [i for i in tokens if not held[i]]
    c1, c2 = Counter(w for i in train for w in tokens[i]), Counter(p for i in train for p in pairs[i])
    n, v = sum(c1.values()), len(c1)
    context = lambda p, c: c[None] if p[0] is True else c[p[0]]
    bucket = lambda c: math.ceil(math.log2(c + 1))
    cell = lambda p: round(math.log2(p) * 4) if p > 0 else lm_scoring._ABSENT
    cells = Counter()
    for i in train:
        own1, own2 = c1 - Counter(tokens[i]), c2 - Counter(pairs[i])
        for p in pairs[i]:
            c = context(p, own1)
            cells[bucket(c), cell(own2[p] / max(c, 1)), cell(own1[p[1]] / (n - len(tokens[i])))] += 1
    w = lm_scoring.learn_weights([(*k, m) for k, m in cells.items()], 1 / (v + 1))
    for i, g in by_id(lm_scoring.score_documents(docs)).items():
        want = 0.0
        for p in pairs[i]:
            c = context(p, c1)
            a = w[bucket(c)]
            want += math.log10(a[0] * c2[p] / max(c, 1) + a[1] * c1[p[1]] / n + a[2] / (v + 1))
        assert g["score"] == pytest.approx(want, rel=1e-6)
