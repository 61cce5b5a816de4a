"""The n-gram join against all pairs, its filters, and rows that repeat an id."""

from __future__ import annotations

import random

import numpy as np
import pytest

from clausemill.llm import jaccard_join, minhash_dedup, set_links
from tests.llm.test_operators import LOWER, WORD, by_id, docs, empty, texts  # noqa: F401


def brute(texts: dict[int, str], words: int, percent: int = 80) -> dict[int, dict]:
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.translate(LOWER))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {i: {"n_shingles": len(s), "component_id": root(i)} for i, s in sets.items()}


def result(df) -> dict[int, dict]:
    return {i: {k: r[k] for k in ("n_shingles", "component_id")} for i, r in by_id(df).items()}


@pytest.mark.parametrize("words", [1, 2, 5])
def test_equals_all_pairs(docs, empty, words):  # noqa: F811
    assert result(jaccard_join.jaccard_join(docs, words)) == brute(texts(), words)
    assert jaccard_join.jaccard_join(empty).collect() == []


def near_copies(seed: int) -> dict[int, str]:
    """Copies of a few texts with every share of words changed, so that many pairs are close to the limit."""
    r = random.Random(seed)
    say = lambda n: [r.choice("abcdefghijklmnop") + str(r.randrange(60)) for _ in range(n)]
    out = []
    for _ in range(4):
        base = say(r.randint(20, 120))
        for _ in range(40):
            words = list(base)
            for _ in range(r.randint(0, 6)):
                words[r.randrange(len(words))] = r.choice(base) if r.random() < 0.3 else "new" + str(r.randrange(999))
            out.append(" ".join(words[: len(words) - r.randint(0, 8)]))
    r.shuffle(out)
    return dict(enumerate(out))


@pytest.mark.parametrize("block", [256, 3])
def test_close_to_the_limit(spark, monkeypatch, block):
    monkeypatch.setattr(set_links, "_BLOCK", block)
    monkeypatch.setattr(set_links, "_TOGETHER", block)
    for seed, words in ((1, 2), (2, 5)):
        t = near_copies(seed)
        df = spark.createDataFrame([*t.items()], "doc_id long, text string").repartition(5)
        assert result(jaccard_join.jaccard_join(df, words)) == brute(t, words)
        found = result(minhash_dedup.near_duplicates(df, words))
        want = brute(t, words)
        # A signature may miss a pair at the limit, at 7e-5; here it misses none.
        assert found == want


def test_filters_keep_every_link():
    """By all pairs of random sets: where two linked sets share their first prefix shingle, every filter passes."""
    r = np.random.default_rng(3)
    near = jaccard_join.NearSets(80)
    for _ in range(400):
        base = r.choice(1 << 30, r.integers(1, 60), replace=False).astype(np.uint64)
        a = np.unique(np.where(r.random(len(base)) < 0.1, r.integers(0, 1 << 30, len(base)), base).astype(np.uint64))
        b = np.unique(base)
        both = len(np.intersect1d(a, b))
        linked = 100 * both >= 80 * (len(a) + len(b) - both)
        row = lambda x: np.array(jaccard_join._counts(jaccard_join._bins(x), np.array([0]), np.array([len(x)])).to_pylist())
        assert near.blocks(np.array([len(a)]), row(a), np.array([len(b)]), row(b))[0, 0] or not linked
        if linked:
            prefix = lambda x: x[: len(x) - -(-80 * len(x) // 100) + 1]
            assert len(np.intersect1d(prefix(a), prefix(b)))


@pytest.mark.parametrize("join", [jaccard_join.jaccard_join, minhash_dedup.near_duplicates])
def test_repeated_ids_are_one_document(spark, join):
    a = " ".join(f"a{k}" for k in range(60))
    b = " ".join(f"b{k}" for k in range(60))
    rows = [(1, a), (1, b), (1, b), (2, a), (3, b), (4, None), (4, a), (5, ""), (5, None)]
    got = result(join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    other = result(join(spark.createDataFrame(rows[::-1], "doc_id long, text string").coalesce(1)))
    assert got == other
    assert {i: r["n_shingles"] for i, r in got.items()} == {1: 56, 2: 56, 3: 56, 4: 56, 5: 0}
    one = got[2]["component_id"], got[3]["component_id"]
    assert one in ((1, 3), (2, 1)) and got[4]["component_id"] == one[0] and got[5]["component_id"] == 5


def test_a_block_puts_out_a_spanning_forest():
    r = np.random.default_rng(5)
    for _ in range(200):
        x, y = r.integers(1, 9, 2)
        linked = r.random((x, y)) < r.choice([0.1, 0.3])
        left, right = np.arange(x), 100 + np.arange(y)
        joined = lambda links: {frozenset(c) for c in _components([*left.tolist(), *right.tolist()], links)}
        a, b = set_links._forest(left, right, linked)
        assert len(a) < x + y
        assert joined(list(zip(a.tolist(), b.tolist()))) == joined([(int(left[i]), int(right[j])) for i, j in zip(*np.nonzero(linked))])


def _components(nodes, links):
    comp = {v: {v} for v in nodes}
    for a, b in links:
        both = comp[a] | comp[b]
        for v in both:
            comp[v] = both
    return {id(c): c for c in comp.values()}.values()


def test_slack_bounds_every_pair_that_can_be_linked():
    near = jaccard_join.NearSets(80)
    n = np.arange(1, 400)
    n1, n2 = n[:, None], n[None, :]
    fits = 100 * np.minimum(n1, n2) >= 80 * np.maximum(n1, n2)
    most = np.where(fits, n1 + n2 - 2 * -(-80 * (n1 + n2) // 180), -1).max(axis=1)
    assert (near.slack(n) >= most).all()
