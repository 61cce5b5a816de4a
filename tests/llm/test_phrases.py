"""Phrases against counting every sequence, the tiles, and odd tables."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from clausemill.llm import common, phrases
from tests.llm.test_operators import LOWER


def brute(rows, min_count=30, top=2000, max_words=4, covered=80):
    f = {}
    for lang, text in rows:
        own = f.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        cand = {p: c for p, c in own.items() if len(p) > 1 and c >= min_count}
        inside = {}
        for p, c in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside.get(p[i : i + k], 0), c)
        mine = []
        for p, a in cand.items():
            if 100 * inside.get(p, -1) >= covered * a:
                continue
            score, _, l, r = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            mine.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def corpus(seed=1):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "The", "of\x00", "日本", "naïve", "\x85x", "\xa0", " "]
    fixed = [["new", "york", "city", "hall"], ["in", "spite", "of"], ["la", "la"], ["Good", "Morning"]]
    rows = []
    for d in range(160):
        words = []
        for _ in range(r.randint(0, 120)):
            words += [r.choice(vocab)] if r.random() < 0.7 else r.choice(fixed)
            words[-1] += r.choice(["", "", "", "", "", ".", ",", "!?", "\n", "\r\n", "\x0b", "\t", " "])
        rows.append((r.choice(["en", "en", "de", None, "und"]), " ".join(words)))
    return rows + [("en", None), ("xx", ""), ("en", " .. ,, "), (None, "la " * 200), ("en", "x" * 5000), ("en", "only"), ("yy", "rare words here")]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, lang, text, i, i, "k") for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, n long, part long, key string")
    return sorted(map(tuple, phrases.mine_phrases(df.repartition(4), **kw).collect()))


@pytest.mark.parametrize("kw", [{}, {"min_count": 5, "top": 7}, {"min_count": 2, "max_words": 3}, {"min_count": 4, "max_words": 6, "covered": 60}])
def test_equals_counting_every_sequence(spark, kw):
    rows = corpus()
    want = brute(rows, **kw)
    kw = {("covered_percent" if k == "covered" else k): v for k, v in kw.items()}
    assert len(want) > 5 and run(spark, rows, **kw) == want


def test_many_parts_salts_and_tiles(spark, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(phrases, "bundles_and_parts", lambda d: (common.make_bundles(d, 900), 8))
    monkeypatch.setattr(phrases, "isqrt", lambda n: 12)
    assert run(spark, rows, min_count=6) == brute(rows, min_count=6)


def test_no_documents(spark):
    assert run(spark, []) == [] and run(spark, [(None, None), ("en", "a b")]) == []


def test_dense_and_sparse_tiles_count_alike():
    r = np.random.default_rng(1)
    for spread in (200, 700, 1 << 30):
        symbols = np.where(r.random(60_000) < 0.1, 0, 1 + np.minimum(r.integers(0, spread, 60_000), r.integers(0, spread, 60_000))).astype(np.uint32)
        at, codes = phrases.pair_codes(symbols)
        left, right = phrases.ids_of(codes)
        assert (left == symbols[at].astype(np.int64) - 1).all() and (right == symbols[at + 1].astype(np.int64) - 1).all()
        cells, counts = phrases.count_cells(codes)
        want = np.unique(codes, return_counts=True)
        assert (cells == want[0]).all() and (counts == want[1]).all()
        again, sums = phrases.count_cells(np.concatenate([cells, cells]), np.concatenate([counts, 2 * counts]))
        assert (again == cells).all() and (sums == 3 * counts).all()
    assert [len(x) for x in phrases.count_cells(np.zeros(0, np.uint64))] == [0, 0]
