"""Each operator against brute force on small tables with nulls, empty texts, ties, repeats and clashing columns."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from clausemill.llm import decontaminate, lm_scoring, minhash_dedup, sentencepiece_codec, substring_dedup, suffix_dedup, token_output, warc
from clausemill.llm.common import make_bundles
from clausemill.llm.line_dedup import drop_lines, line_dedup
from clausemill.llm.quality_rules import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
UPPER = {v: k for k, v in LOWER.items()}
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def corpus(seed: int = 5) -> list[tuple[int, str | None]]:
    """Prose with copies, near copies, shared passages and odd texts."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéñ") for _ in range(r.randint(1, 6))) for _ in range(150)] + ["The", "A", "#x", "你好"]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base = [say(r.randint(60, 160)) for _ in range(12)]
    passage, line = say(70), "Shared line " + say(4)
    texts: list[str | None] = [None, "", " \n\t ", "one", "two words", "x" * 3000, "ab" * 800, "a b " * 300, "\n".join([line] * 3)]
    for t in base:
        texts += [t, t]
        words = t.split()
        words[r.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
        words[r.randrange(len(words))] = "Again"
        texts.append(" ".join(words) + "\n" + line)
        texts.append(say(20) + " " + passage + "\n" + say(15) + "\n" + "  " + line.upper() + " ")
        texts.append(say(5) + passage[40:300] + " " + passage)
    ids = list(range(len(texts)))
    r.shuffle(ids)
    return list(zip(ids, texts))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 5 == 0 else f"h{i % 2}", len(t or ""), i) for i, t in corpus()]
    # key, n, part and text-like names clash with the operators' own columns
    return spark.createDataFrame([*rows, (None, "no id", None, 5, -1)], "doc_id long, text string, source string, n_chars long, k1 long").repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def by_id(df) -> dict:
    rows = [r.asDict() for r in df.collect()]
    out = {r.pop("doc_id"): r for r in rows}
    assert len(out) == len(rows)
    return out


def texts() -> dict[int, str]:
    return {i: t or "" for i, t in corpus()}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(docs, empty, words):
    sets = {}
    for i, t in texts().items():
        w = WORD.findall(t.translate(LOWER))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    got = by_id(minhash_dedup.near_duplicates(docs, words=words))
    assert {i: (g["n_shingles"], g["component_id"], g["kept"]) for i, g in got.items()} == {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}
    assert minhash_dedup.near_duplicates(empty).collect() == []


def test_signature_distance_is_covered_by_the_index():
    r = np.random.default_rng(1)
    for _ in range(300):
        wrong = set(r.choice(minhash_dedup.SYMBOLS, minhash_dedup.DISTANCE, replace=False).tolist())
        per_chunk = [sum(c * minhash_dedup.CHUNK + i in wrong for i in range(minhash_dedup.CHUNK)) for c in range(minhash_dedup.CHUNKS)]
        assert min(per_chunk) <= minhash_dedup.ERRORS


def test_token_blocks_round_trip():
    r = np.random.default_rng(2)
    cases = [np.zeros(0), np.array([7]), np.full(100, 9), r.integers(0, 50_000, 4096), np.append(r.integers(0, 30, 500), [2**32 - 1, 0]), np.array([2**32 - 1] * 3)]
    for ids in cases:
        ids = ids.astype(np.uint32)
        assert (token_output.unpack_block(token_output.pack_block(ids)) == ids).all()


def test_token_output(docs, empty, spark, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    start, want = 0, {}
    for i, t in sorted(texts().items()):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want[i] = {"start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())}
        start += len(ids)
    assert by_id(token_output.token_output(docs, BPE)) == want
    # small shards, random access
    path = f"file://{tmp_path}/shards"
    token_output.write_tokens(docs, path, lambda: token_output.CachedEncoder(BPE), shard_bytes=4000)
    shards = [token_output.Shard(bytes(r.content)) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").collect()]
    assert len(shards) > 3
    for s in shards:
        for i, at, n in zip(s.doc_ids.tolist(), s.starts.tolist(), s.sizes.tolist()):
            assert zlib.crc32(s.ids(at, n).astype("<u4").tobytes()) == want[i]["ids_crc32"]
    assert token_output.token_output(empty, BPE).collect() == []


@pytest.mark.parametrize("text", ["a  b", " lead", "trail ", "tab\t x", "nb  sp", "end\n next", "<|endoftext|> x", "it's we'll  \n\n  x", "　 wide", "日本 語 text", "a " * 50])
def test_cached_encoder_equals_the_library(text):
    enc = token_output.CachedEncoder(BPE)
    for _ in range(2):
        assert enc.encode(text).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_lm_scoring(docs, empty):
    docs_of = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in texts().items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs_of}
    counts = Counter(w for i, d in docs_of.items() if not held[i] for w in d)
    n, v = sum(counts.values()), len(counts)
    got = by_id(lm_scoring.score_documents(docs))
    assert set(got) == set(docs_of)
    for i, d in docs_of.items():
        g = got[i]
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (held[i], len(d), sum(w in counts for w in d), n)
        assert g["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in d), rel=1e-9)
        assert math.isfinite(g["score"]) and g["score"] <= 0
    # the mixture predicts held-out text better than the add-one base
    assert sum(g["score"] for g in got.values() if g["held_out"]) > sum(g["base_score"] for g in got.values() if g["held_out"])
    assert lm_scoring.score_documents(empty).collect() == []


def test_lm_mixture_is_a_distribution(docs):
    """For a seen and for an unseen context, the model's probabilities sum to one over words, end and unknown."""
    w = lm_scoring.learn_weights([(3, -4, -20, 50), (3, lm_scoring._ABSENT, -20, 20), (0, lm_scoring._ABSENT, -12, 5)], 1e-3)
    assert np.allclose(w.sum(axis=1), 1) and w[0, 0] == 0 and w[3, 0] > w[3, 2] > 0


def test_lm_without_folds(docs):
    all_train = by_id(lm_scoring.score_documents(docs, held_out=lambda ids: np.zeros(len(ids), np.int32)))
    none_train = by_id(lm_scoring.score_documents(docs, held_out=lambda ids: np.ones(len(ids), np.int32)))
    assert all(g["n_known"] == g["n_tokens"] for g in all_train.values())
    assert all(g["n_known"] == g["train_tokens"] == 0 and math.isfinite(g["score"]) for g in none_train.values())


def library_ids(text: str) -> list[int]:
    return sentencepiece_codec.pieces(PIECES).library.encode(text)


def test_sentencepiece_ids_are_the_librarys(docs):
    for i, g in by_id(sentencepiece_codec.encode(docs, PIECES)).items():
        assert np.frombuffer(g["ids"], "<u4").tolist() == library_ids(texts()[i])
    for t in ("a", " ", "  ", " lead", "trail ", "double  space", "▁mark▁", "new\nline \n", "日本語テキスト", "e\u0301 ﬁ \x00 \x7f", "💩💩 x", "www...... ====  -----"):
        p = sentencepiece_codec.pieces(PIECES)
        for _ in range(2):
            assert np.frombuffer(p.encode(sentencepiece_codec.mark(t)), "<u4").tolist() == library_ids(t)


def test_merges_are_the_librarys():
    p = sentencepiece_codec.pieces(PIECES)
    r = random.Random(3)
    for _ in range(300):
        t = "".join(r.choice("thereinonabsz") for _ in range(r.randint(1, 24)))
        want = [p.library.id_to_piece(i) for i in library_ids(t)]
        assert p.merge("▁" + t) == want == p.path(None, "▁" + t)


@pytest.mark.parametrize("chunk", [1, 23, 64, 1000])
def test_sentencepiece_chunks_do_not_matter(spark, docs, chunk):
    r = random.Random(chunk)
    rows = [(i, "".join(r.choice("thereinonabsz") for _ in range(r.randint(1, chunk + 400)))) for i in range(6)]
    rows += [(10 + i, " ".join("".join(r.choice("thereinonaé  \n你") for _ in range(r.randint(1, 12))) for _ in range(60))) for i in range(6)]
    rows += [(i + 100, t) for i, t in corpus() if chunk > 100]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(sentencepiece_codec.encode(table, PIECES, chunk_chars=chunk))
    assert {i: np.frombuffer(g["ids"], "<u4").tolist() for i, g in got.items()} == {i: library_ids(t or "") for i, t in rows}


def test_max_plus_products_are_associative():
    r = np.random.default_rng(1)
    a, b, c = (np.where(r.random((4, 4)) < 0.3, -np.inf, r.integers(-9, 9, (4, 4))) for _ in range(3))
    mul = sentencepiece_codec.combine
    assert (mul(mul(a, b), c) == mul(a, mul(b, c))).all()
    assert (sentencepiece_codec.prefix_scan(np.stack([a, b, c]))[2] == mul(mul(a, b), c)).all()


def test_sentencepiece_round_trip(docs, empty):
    for i, g in by_id(sentencepiece_codec.round_trip(docs, PIECES)).items():
        assert g["decoded_sha256"] == hashlib.sha256(texts()[i].encode()).hexdigest() and (g["n_pieces"] > 0) == bool(texts()[i])
    assert sentencepiece_codec.round_trip(empty, PIECES).collect() == []


def test_warc(spark):
    r = random.Random(3)
    html = ["<p>" + "x" * 200, "short", None, "<p>é" + "y" * 300, "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 5]
    rows = [(i, None if i % 11 == 0 else f"https://www.b{i % 3}.a.org:80/p {i % 4}?q\n#f", r.choice(html), "clash") for i in range(200)]
    r.shuffle(rows)
    pages = spark.createDataFrame([*rows, (None, "http://x", "y", "c")], "page_id long, url string, html string, digest string")
    first: dict = {}
    for i, _, h, _ in sorted(rows):
        first.setdefault((h or "").encode(), i)
    got = {g.page_id: g for g in warc.archive(pages).collect()}
    assert len(got) == len(rows)
    for i, u, h, _ in rows:
        raw, g = (h or "").encode(), got[i]
        revisit = len(raw) >= 100 and first[raw] != i
        assert (g.payload_bytes, g.payload_digest, g.record_type, g.refers_to) == (len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[raw] if revisit else None)
        assert u is None or g.url_key == f"org,a,b{i % 3})/p%20{i % 4}?q%0a".replace("%0a", "%20")
    order = sorted(got.values(), key=lambda g: (g.url_key, g.captured, g.page_id))
    assert [g.capture_no for g in order] == list(range(len(rows)))
    assert warc.archive(pages.limit(0)).collect() == []


def test_warc_records_are_gzip_members(spark, tmp_path):
    long = random.Random(5).randbytes(9 << 20).hex()
    html = {1: "a" * 500, 2: None, 3: long, 4: "a" * 500, 5: "\u00e9\x00\r\n\r\n"}
    pages = spark.createDataFrame(list(html.items()), "page_id long, html string").selectExpr("page_id", "'http://x.org' url", "html")
    got = {g.page_id: g for g in warc.archive(pages, f"file://{tmp_path}/w").collect()}
    assert len(got) == 5
    for i, text in html.items():
        with open(got[i].archive.removeprefix("file:"), "rb") as f:
            f.seek(got[i].record_offset)
            record = zlib.decompressobj(31).decompress(f.read())
        assert f"<urn:page:{i}>".encode() in record.partition(b"\r\n\r\n")[0]
        payload = b"" if i == 4 else (text or "").encode()
        assert record.endswith(b"\r\n\r\n" + payload + b"\r\n\r\n")


def test_warc_parse_reads_one_stream_and_refuses_a_cut_one():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n\r\n"
    one, many = gzip.compress(record * 3), gzip.compress(record) * 3
    assert [(b, o) for _, b, o in warc.parse(one)] == [(b"abc\r\n", 0)] * 3
    assert [(b, o) for _, b, o in warc.parse(many)] == [(b"abc\r\n", k * len(many) // 3) for k in range(3)]
    for cut in (one[:-3], many[:-3], many[:-40]):
        with pytest.raises(ValueError):
            list(warc.parse(cut))


def test_index_ranges_merge_in_order(spark, tmp_path):
    rows = [(i, f"http://s{i % 7}.org/{i % 13}", "z" * (i % 40)) for i in range(600)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), f"file://{tmp_path}/w", file_bytes=500)
    index = warc.merge_index(warc.read_runs(spark, f"file://{tmp_path}/w"), per_range=40).collect()
    assert len({g.run for g in index}) > 5 and len({g.index_range for g in index}) > 5
    order = sorted(index, key=lambda g: (g.url_key, g.captured, g.page_id))
    assert [g.capture_no for g in order] == list(range(600))


def test_loser_tree():
    r = random.Random(4)
    for k in range(12):
        runs = [sorted(r.randrange(50) for _ in range(r.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_line_dedup(docs, empty):
    seen: dict = {}
    for i, t in texts().items():
        for k in {x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in t.split("\n")}:
            seen[k] = seen.get(k, 0) + 1
    want = {}
    for i, t in texts().items():
        lines = t.split("\n")
        kept = [x for x in lines if seen[k := x.strip(" \t\n\x0b\x0c\r").translate(LOWER)] < 10 or not k]
        want[i] = {"kept_text": "\n".join(kept), "n_lines": len(lines), "n_dropped": len(lines) - len(kept), "kept_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest()}
    assert by_id(line_dedup(docs)) == want
    kept = by_id(drop_lines(docs))
    assert {i: (g["text"], g["n_chars"]) for i, g in kept.items()} == {i: (g["kept_text"], len(g["kept_text"])) for i, g in want.items()}
    assert line_dedup(empty).collect() == [] == drop_lines(empty).collect()


def test_quality_rules(spark, docs, empty):
    got = by_id(quality_rules(docs))
    for i, t in texts().items():
        w = WORD.findall(t)
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        twice = {g for g, n in Counter(grams).items() if n > 1}
        repeat = len({k + j for k, g in enumerate(grams) if g in twice for j in range(3)})
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeat)
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert got[i]["base_failed"] == (len(w) < 50 or 100 * repeat > 50 * len(w))
        assert got[i]["kept"] <= (not got[i]["base_failed"])
    assert quality_rules(empty).collect() == []


def test_quality_rules_reject_depleted_documents_only(spark):
    r = random.Random(8)
    say = lambda n: " ".join("w%d" % r.randrange(10**6) for _ in range(n))
    menu = [say(20) for _ in range(6)]
    rows = [(i, "\n".join(x + "\n" + say(3) for x in r.sample(menu, 4)), "a") for i in range(60)]
    clean = [(100 + i, menu[0] + "\n" + say(60) + "\n" + say(60), "a") for i in range(60)]
    one = [say(30) for _ in range(4)]
    copies = [(200 + i, "\n".join(one) if i % 2 else "\n".join([*one[:3], one[3] + f" {i}"]), "a") for i in range(60)]
    got = by_id(quality_rules(spark.createDataFrame(rows + clean + copies, "doc_id long, text string, source string")))
    assert not any(got[i]["kept"] for i, _, _ in rows)
    assert all(got[i]["kept"] for i, _, _ in clean + copies)


def naive_bytes(all_texts: dict[int, bytes], n: int) -> dict:
    seen: dict = {}
    out = {}
    for i in sorted(all_texts):
        b, gone = all_texts[i], [False] * len(all_texts[i])
        for k in range(len(b) - n + 1):
            if b[k : k + n] in seen:
                gone[k : k + n] = [True] * n
            seen.setdefault(b[k : k + n], (i, k))
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = {"n_bytes": len(b), "n_removed": sum(gone), "n_spans": spans, "kept": bytes(x for x, g in zip(b, gone) if not g)}
    return out


@pytest.mark.parametrize("length", [16, 51, 100])
def test_suffix_dedup(docs, empty, length):
    got = by_id(suffix_dedup.remove_repeats(docs, length))
    want = naive_bytes({i: t.encode() for i, t in texts().items()}, length)
    assert {i: {**g, "kept": bytes(g["kept"])} for i, g in got.items()} == want
    assert suffix_dedup.remove_repeats(empty).collect() == []


def test_suffix_dedup_over_many_bundles(docs, monkeypatch):
    """Small bundles, slices and sorts give the same result."""
    monkeypatch.setattr(suffix_dedup, "_SLICE", 700)
    monkeypatch.setattr(suffix_dedup, "_SORTED", 50)
    monkeypatch.setattr(suffix_dedup, "bundles_and_parts", lambda d: (make_bundles(d, 2000), 8))
    got = by_id(suffix_dedup.remove_repeats(docs, 100))
    want = naive_bytes({i: t.encode() for i, t in texts().items()}, 100)
    assert {i: {**g, "kept": bytes(g["kept"])} for i, g in got.items()} == want


def naive_words(all_texts: dict[int, str], n: int) -> dict:
    first: dict = {}
    for i in sorted(all_texts):
        w = WORD.findall(all_texts[i])
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k : k + n]), i)
    out = {}
    for i, t in all_texts.items():
        w = WORD.findall(t)
        gone = {k + j for k in range(len(w) - n + 1) if first[tuple(w[k : k + n])] < i for j in range(n)}
        out[i] = {"n_words": len(w), "n_removed": len(gone), "kept_text": " ".join(x for k, x in enumerate(w) if k not in gone)}
    return out


@pytest.mark.parametrize("length", [2, 7, 50])
def test_substring_dedup(docs, empty, length):
    assert by_id(substring_dedup.remove_repeats(docs, length)) == naive_words(texts(), length)
    assert substring_dedup.remove_repeats(empty).collect() == []


def test_bundles_of_any_size_give_the_same(docs, monkeypatch):
    for module in (substring_dedup, lm_scoring):
        monkeypatch.setattr(module, "bundles_and_parts", lambda d, kind=None: (make_bundles(d, 1500, kind), 1))
    whole = by_id(lm_scoring.score_documents(docs))
    for module in (substring_dedup, lm_scoring):
        monkeypatch.setattr(module, "bundles_and_parts", lambda d, kind=None: (make_bundles(d, 1500, kind), 1 << 20))
    assert by_id(substring_dedup.remove_repeats(docs, 50)) == naive_words(texts(), 50)
    parts = by_id(lm_scoring.score_documents(docs))
    assert all(parts[i]["score"] == pytest.approx(g["score"]) for i, g in whole.items())


def naive_distance(p: str, t: str) -> int:
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for k, x in enumerate(p, 1):
            new.append(min(row[k] + 1, new[-1] + 1, row[k - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


def test_bit_parallel_distance():
    r = random.Random(6)
    for _ in range(200):
        p = "".join(r.choice("abc") for _ in range(r.randint(1, 30)))
        t = "".join(r.choice("abc") for _ in range(r.randint(0, 60)))
        d = naive_distance(p, t)
        assert decontaminate.within(p, t, len(p)) == d and decontaminate.within(p, t, d - 1) is None


def test_decontamination(spark, docs, empty, monkeypatch):
    r = random.Random(7)
    plain = {i: t for i, t in texts().items()}
    words = WORD.findall(" ".join(plain.values()))
    items = {k: " ".join(r.choice(words) for _ in range(r.randint(8, 20))) for k in range(12)}
    items[50], items[51] = "", "short one"
    rows = []
    for k in range(60):
        t = items[k % 12]
        for _ in range(r.randint(0, len(t) // 7)):
            a = r.randrange(len(t))
            t = r.choice([t[:a] + t[a + 1 :], t[:a] + "q" + t[a:], t[:a] + "z" + t[a + 1 :]])
        rows.append((1000 + k, " ".join(r.choices(words, k=20)) + " \n" + t.translate(UPPER) + "\t " + " ".join(r.choices(words, k=20))))
    rows += list(plain.items())
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([*items.items(), (60, None), (None, "x" * 80)], "item_id long, text string")
    want = {}
    for i, t in rows:
        n = decontaminate.normalise(t)
        hits = {}
        for k, x in items.items():
            x = decontaminate.normalise(x)
            if x and (d := naive_distance(x, n)) <= len(x) // 10:
                hits[k] = d
        want[i] = {"n_items": len(hits), "item_ids": sorted(hits), "distances": [hits[k] for k in sorted(hits)], "contaminated": bool(hits)}
    assert {w["contaminated"] for i, w in want.items() if i >= 1000} == {True, False}
    assert by_id(decontaminate.find_items(table, bench)) == want
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)
    assert by_id(decontaminate.find_items(table, bench)) == want
    assert decontaminate.find_items(empty, bench).collect() == []
    assert not any(g["contaminated"] for g in by_id(decontaminate.find_items(docs, bench.limit(0))).values())
