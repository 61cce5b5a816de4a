"""Rows that repeat an id with different contents, and texts that hold the operators' own marks."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers

from clausemill.llm import decontaminate, token_output, warc


def test_a_repeated_page_id_keeps_every_payload(spark, tmp_path):
    a, b, c = "a" * 200, "b" * 200, "c" * 200
    rows = [(1, None, a), (2, None, a), (2, None, b), (3, None, b), (3, None, b), (3, None, c), (3, None, a)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive(pages, f"file://{tmp_path}/w").collect())
    name = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(1, name(a), "response", None), (2, name(a), "revisit", 1), (2, name(b), "response", None), (3, name(b), "revisit", 2), (3, name(b), "revisit", 2), (3, name(c), "response", None), (3, name(a), "revisit", 1)]
    assert got == sorted(want)
    blocks = [block for r in spark.read.format("binaryFile").load(f"file://{tmp_path}/w/part-*").collect() for _, block, _ in warc.parse(bytes(r.content))]
    for payload in (a, b, c):
        assert sum(block.endswith(payload.encode()) for block in blocks) == 1


def test_cached_encoder_equals_the_library_on_random_texts():
    enc = token_output.CachedEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(7)
    signs = [*map(chr, range(0, 33)), "\x7f", "\x85", "\xa0", "\u2028", "\ufeff", *"ab.,;:!?#*%'é1日\n  ", "the", " of", "<|endoftext|>"]
    texts = ["".join(r.choice(signs) for _ in range(r.randint(0, 12))) for _ in range(6000)] + ["b \x01", "\x01", "a\x01.", "a.\x01"]
    import pyarrow as pa

    got = enc.encode_all(pa.array(texts, pa.string()))
    want = enc._whole(texts)
    assert [(t, g.tolist()) for t, g in zip(texts, got)] == list(zip(texts, want))


def test_repeated_documents_are_judged_alike_with_any_number_of_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon"), (2, "one two three four five six seven")], "item_id long, text string")
    held, clean = "x alpha beta gamma delta epsilon y", "nothing of the kind"
    docs = spark.createDataFrame([(5, held), (5, held), (5, clean), (6, None), (7, held + " one two three four five six seven")], "doc_id long, text string")
    found = lambda: sorted(map(tuple, decontaminate.find_items(docs, items).collect()))
    one = found()
    assert [(r[0], r[2]) for r in one] == [(5, []), (5, [1]), (5, [1]), (6, []), (7, [1, 2])]
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 20)
    assert found() == one
