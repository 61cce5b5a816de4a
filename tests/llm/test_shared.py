"""Shared helpers, and cases that only they decide."""

from __future__ import annotations

import numpy as np
import pytest

from clausemill.llm import common, suffix_dedup
from clausemill.llm.common import make_bundles
from tests.llm.test_operators import by_id, docs, naive_bytes, texts  # noqa: F401


def test_words_with_nul_have_their_own_hashes():
    words = ["b", "a\0", "\0", "\0\0", "a", "a\0\0", "b\0", "\0b"]
    for base in (common.BASE_A, common.BASE_B):
        w = common.Words([" ".join(words).encode()])
        assert len(set(common.span_hashes(w.buf, w.starts, w.ends, base).tolist())) == len(words)


def test_hashes_do_not_depend_on_slices(monkeypatch):
    r = np.random.default_rng(3)
    values = r.integers(0, 256, 3000).astype(np.uint8)
    starts = np.sort(r.integers(0, 2900, 200))
    ends = np.maximum.accumulate(np.minimum(starts + r.integers(1, 90, 200), 3000))
    long = np.array([0]), np.array([3000])
    want = [common.span_hashes(values, starts, ends), common.span_hashes(values, *long), common.window_hashes(values, 50), common.window_hashes(values[:4], 4)]
    monkeypatch.setattr(common, "SLICE", 128)
    monkeypatch.setattr(common, "_powers", lambda base, n=129, real=common._powers: real(base, n))
    got = [common.span_hashes(values, starts, ends), common.span_hashes(values, *long), common.window_hashes(values, 50), common.window_hashes(values[:4], 4)]
    assert all((a == b).all() for a, b in zip(want, got))


@pytest.mark.parametrize("parts", [1, 2, 64, 1 << 20])
def test_keys_by_part(parts):
    h = np.random.default_rng(4).integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    h = np.concatenate([h, h[:100]])
    tails, inverse, part = common.unique_keys(h, parts, 48)
    cuts = list(common.cuts_by_part(part))
    assert sum(b - a for _, a, b in cuts) == len(tails) == 5000
    for p, a, b in cuts:
        assert (part[a:b] == p).all() and (common.joined(common.planes(tails[a:b], 6)) == tails[a:b]).all()
    assert (tails[inverse[:100]] == tails[inverse[5000:]]).all()


def test_gather():
    flat, ends = common.gather(np.arange(10), np.array([3, 0, 5, 2]), np.array([2, 0, 1, 2]))
    assert flat.tolist() == [3, 4, 5, 6, 7, 0, 1, 2, 3, 4, 5, 6, 7] and ends.tolist() == [5, 8, 8, 13]


def test_hot_anchors(docs, monkeypatch):  # noqa: F811
    """Anchors in many places are judged window by window, with the same result."""
    want = naive_bytes({i: t.encode() for i, t in texts().items()}, 100)
    for hot in (1, 4):
        monkeypatch.setattr(suffix_dedup, "_HOT", hot)
        monkeypatch.setattr(suffix_dedup, "bundles_and_parts", lambda d: (make_bundles(d, 2000), 8))
        got = by_id(suffix_dedup.remove_repeats(docs, 100))
        assert {i: {**g, "kept": bytes(g["kept"])} for i, g in got.items()} == want


def test_scratch_folders_go(spark):
    with common.scratch_folder(spark):
        df = common.materialize(spark.range(3))
        path = common._WRITTEN[df]
        assert df.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
