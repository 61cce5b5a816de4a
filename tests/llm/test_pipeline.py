"""The corpus pipeline against brute force, stage by stage, on a small corpus."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from clausemill.llm import decontaminate, sentencepiece_codec
from tests.llm.test_operators import LOWER, PIECES, WORD, naive_distance

WS = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(11)
    say = lambda n: " ".join("w%d" % r.randrange(4000) for _ in range(n))
    footer, items = "All rights reserved " + say(3), {k: say(14) for k in range(5)}
    rows, i = [], 0
    for k in range(40):
        text = "\n".join(say(30) for _ in range(4)) + (f"\n {footer.upper()} " if k % 2 else "")
        if k % 8 == 3:
            text += "\n" + say(5) + " " + items[k % 5].replace("w1", "v1", 1) + " " + say(5)
        rows.append((i, text))
        if k % 5 == 0:
            rows += [(i + 1, text), (i + 2, text.replace("w", "W", 1) + " tail")]
        i += 5
    menu = [say(20) for _ in range(3)]
    for k in range(14):  # depleted documents, and copies, of one source
        i += 3
        rows += [(i, "\n".join([*menu, say(20)])), (i + 3000, "\n".join(menu[:2]) + " and so on " * (k % 2) + "\n" + footer)]
    i += 10_000
    rows += [(i, None), (i + 1, ""), (i + 2, "too short"), (i + 3, "same words here " * 40), (None, say(60))]
    r.shuffle(rows)
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(d, t, "en", f"src{(d or 0) % 3}", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, {d: t for d, t in rows if d is not None}, items


def quality(docs: dict, sources: int = 3) -> dict:
    keys, fine, words = {}, {}, {}
    for d, t in docs.items():
        keys[d] = [(d % sources, k) for x in (t or "").split("\n") if (k := " ".join(x.strip(WS).split()).translate(LOWER))]
        w = WORD.findall(t or "")
        words[d] = len(w)
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        fine[d] = len(w) >= 50 and 100 * len(again) <= 50 * len(w)

    def left(group: dict) -> set:
        holders: dict = {}
        for d in docs:
            for k in keys[d]:
                holders.setdefault(k, set()).add(group.get(d, d))
        bad = {k for k, x in holders.items() if len(x) > 10}
        return {d for d in docs if fine[d] and 100 * (words[d] - sum(len(k[1].split()) for k in keys[d] if k in bad)) >= 30 * words[d]}

    suspects = {d: docs[d] for d in docs if fine[d]}
    for d in left({}):
        del suspects[d]
    return {d: docs[d] for d in left(groups(suspects))}


def drop_lines(docs: dict) -> dict:
    key = lambda x: x.strip(WS).translate(LOWER)
    n = Counter(k for t in docs.values() for k in {key(x) for x in t.split("\n")})
    return {d: "\n".join(x for x in t.split("\n") if not key(x) or n[key(x)] < 10) for d, t in docs.items()}


def groups(docs: dict) -> dict:
    sets = {}
    for d, t in docs.items():
        w = WORD.findall(t.translate(LOWER))
        sets[d] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    group = {d: d for d in docs}
    for a in sorted(docs):
        for b in sorted(docs):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((group[a], group[b]))
                group = {d: x if g == y else g for d, g in group.items()}
    return group


def near(docs: dict) -> dict:
    group = groups(docs)
    return {d: t for d, t in docs.items() if group[d] == d}


def clean(docs: dict, items: dict) -> dict:
    norm = {k: decontaminate.normalise(x) for k, x in items.items()}
    return {d: t for d, t in docs.items() if not any(naive_distance(x, decontaminate.normalise(t)) <= len(x) // 10 for x in norm.values())}


def test_stages_and_run(spark, folder):
    path, want, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    for (name, stage), brute in zip(corpus_pipeline.STAGES, [quality, drop_lines, near, lambda d: clean(d, items), None]):
        docs = stage(spark, docs, path)
        if brute is None:
            break
        before, want = want, brute(want)
        rows = docs.collect()
        assert docs.columns == columns and {r.doc_id: r.text for r in rows} == want, name
        assert all(r.n_chars == len(r.text) for r in rows) and want != before
        docs = spark.createDataFrame(rows, docs.schema)
    p = sentencepiece_codec.pieces(PIECES)
    pieces = {d: p.library.encode(t) for d, t in want.items()}
    expect = {d: (len(x), zlib.crc32(np.array(x, "<u4").tobytes()), len(want[d]), hashlib.sha256(want[d].encode()).hexdigest()) for d, x in pieces.items()}
    for out in (docs, corpus_pipeline.run(spark, path)):
        assert {r.doc_id: tuple(r)[1:] for r in out.collect()} == expect


def test_empty_table(spark, folder, tmp_path):
    path, _, _ = folder
    spark.read.parquet(f"{path}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
