"""Language-model scoring by deleted interpolation.

Method: maximum-likelihood estimates of bigrams and unigrams and a uniform term, mixed with weights that depend on how
often the context was seen; the weights of each context-frequency bucket are learned by expectation-maximisation on
the training documents, each judged by the counts that are left when its own are deleted. Held-out documents are only
scored.

    P(w | u) = l2[b] c(u, w) / c(u) + l1[b] c(w) / N + l0[b] / (V + 1),  b the bucket of c(u)

The corpus is cut into bundles, each of training or of held-out documents. A bundle asks for the counts of its distinct
words and bigrams once, whatever their number in it; counts are summed where the parts' requests meet and are sent back.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ANSWER, Words, answer_parts, bundles_and_parts, joined, materialize, meet, mix64, pack, planes, requests, unique_keys, unpack

_END = np.uint64(0x452821E638D01377)
_START = np.uint64(0xBE5466CF34E90C6C)
_BITS = 48
#: Steps per doubling when probabilities are put into cells for the weights' estimation; scores use exact values.
_STEPS = 4
_ABSENT = -10_000


def in_fold(ids: np.ndarray, modulus: int = 7, remainder: int = 2) -> np.ndarray:
    """Whether crc32 of the id as text leaves ``remainder``."""
    return np.array([zlib.crc32(str(i).encode()) % modulus == remainder for i in ids.tolist()], dtype=np.int32)


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts, each text's words and then an end; bigram hashes; where each text's tokens begin."""
    w = Words(texts, lower=True)
    docs = np.arange(len(texts))
    first = w.first + np.arange(len(texts) + 1)
    tokens = np.full(first[-1], _END, dtype=np.uint64)
    tokens[np.arange(len(w.hash)) + np.repeat(docs, w.counts)] = w.hash
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first[:-1]] = _START
    return tokens, mix64(before * np.uint64(0x9FB21C651E98DF25) + mix64(tokens)), first


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then one bucket for each doubling."""
    return np.ceil(np.log2(context + 1)).astype(np.int64)


def _repeats(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """How often each hash stands in its owner."""
    order = np.lexsort((hashes, owner))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    which = np.cumsum(new) - 1
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.bincount(which)[which] if len(which) else 0
    return out


class _Counts:
    """A bundle's tokens with the corpus' counts; ``deleted``: without those of the token's own document."""

    def __init__(self, texts: list[bytes], got: dict[int, bytes], parts: int, deleted: bool = False):
        tokens, pairs, self.first = _tokens(texts)
        both = [unpack(got[p]) for p in sorted(got)]
        ones = np.concatenate([b[0] for b in both]).astype(np.float64)
        twos = np.concatenate([b[1] for b in both]).astype(np.float64)
        self.word = ones[unique_keys(tokens, parts, _BITS)[1]]
        self.pair = twos[unique_keys(pairs, parts, _BITS)[1]]
        if deleted:
            owner = np.repeat(np.arange(len(texts)), np.diff(self.first))
            self.word -= _repeats(tokens, owner)
            self.pair -= _repeats(pairs, owner)
        # A word is a context as often as it is a token; a text's start as often as its end.
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[self.first[:-1]] = self.word[self.first[1:] - 1]

    def estimates(self, n: float | np.ndarray, v: float) -> tuple[np.ndarray, np.ndarray, float]:
        return self.pair / np.maximum(self.context, 1), self.word / np.maximum(n, 1.0), 1.0 / (v + 1)


def learn_weights(cells: list[tuple[int, int, int, int]], p0: float, rounds: int = 40) -> np.ndarray:
    """Weights (l2, l1, l0) of each bucket by expectation-maximisation over cells (bucket, log p2, log p1, tokens).
    Buckets without tokens get the weights of all others together."""
    size = 66
    out = np.zeros((size, 3))
    if not cells:
        out[:] = 1 / 3
    else:
        c = np.array(cells, dtype=np.int64)
        value = lambda x: np.where(x == _ABSENT, 0.0, 2.0 ** (x / _STEPS))
        p = np.stack([value(c[:, 1]), value(c[:, 2]), np.full(len(c), p0)], axis=1)
        rows = {b: np.flatnonzero(c[:, 0] == b) for b in np.unique(c[:, 0]).tolist()}
        for b, at in [(-1, np.arange(len(c))), *rows.items()]:
            w = np.full(3, 1 / 3)
            for _ in range(rounds):
                part = p[at] * w
                w = (part / part.sum(axis=1, keepdims=True) * c[at, 3:4]).sum(axis=0)
                w /= w.sum()
            # The uniform term keeps every text possible.
            w = np.maximum(w, [0, 0, 1e-6])
            if b < 0:
                out[:] = w / w.sum()
            else:
                out[b] = w / w.sum()
    out[0] = [0, out[0, 1], out[0, 2]]  # an unseen context has no bigrams
    out[0] /= out[0].sum()
    return out


def score_documents(docs: DataFrame, held_out: Callable[[np.ndarray], np.ndarray] = in_fold) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per document.

    Words are A-Z lower-cased; a text's tokens are its words and one end. Counts and weights come from the documents
    that ``held_out`` does not mark; weights from each one's tokens by the counts of all others (V stays that of all). n_known counts tokens seen in training, train_tokens all
    training tokens N; base_score is the sum of log10((c + 1) / (N + V + 1)) over tokens; score the model's log10
    probability of the text. A null or empty text is the end alone. Without training documents every token is
    unknown and the three terms weigh the same. Other columns are ignored; an empty table gives no
    rows. Memory follows the longest text.
    """
    bundles, parts = bundles_and_parts(docs, held_out)
    kinds = {}

    def ask(kind: int):
        def make(ids: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
            tokens, pairs, _ = _tokens(texts)
            both = []
            for h in (tokens, pairs):
                tails, inverse, part = unique_keys(h, parts, _BITS)
                counts = np.bincount(inverse, minlength=len(tails)).astype(np.uint32) if kind == 0 else np.zeros(len(tails), np.uint32)
                both.append((tails, counts, part))
            (t1, n1, p1), (t2, n2, p2) = both
            met = np.union1d(p1, p2)
            ends = [np.searchsorted(p, met, side=side).tolist() for p in (p1, p2) for side in ("left", "right")]
            for part, a, b, x, y in zip(met.tolist(), *ends):
                yield part, pack(*planes(t1[a:b], _BITS // 8), n1[a:b], *planes(t2[x:y], _BITS // 8), n2[x:y])

        return make

    def answer(bundle_ids: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        rows = [unpack(b) for b in blobs]
        sums, stats = [], None
        size = _BITS // 8
        for k in (0, size + 1):
            tails = [joined(r[k : k + size]) for r in rows]
            unique, inverse = np.unique(np.concatenate(tails), return_inverse=True)
            total = np.bincount(inverse, weights=np.concatenate([r[k + size] for r in rows]), minlength=len(unique)).astype(np.uint64)
            if k == 0:
                stats = np.array([total.sum(), (total > 0).sum()], dtype=np.uint64)
            total = total.astype(np.uint32) if not len(total) or total.max() < 1 << 32 else total
            sums.append(np.split(total[inverse], np.cumsum([len(t) for t in tails])[:-1]))
        for b, one, two in zip(bundle_ids, *sums):
            yield b, pack(one, two)
        yield -1, pack(stats)

    asked = None
    for kind in (0, 1):
        kinds[kind] = bundles.where(F.col("kind") == kind)
        more = requests(kinds[kind], ask(kind))
        asked = more if asked is None else asked.unionByName(more)
    answers = materialize(answer_parts(asked, answer))

    def read_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [unpack(x.as_py())[0].tolist() for x in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(2)], ["n", "v"])

    stats = answers.where("bundle_id = -1").select("blob").mapInArrow(read_stats, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    n, v = float(stats[0] or 0), float(stats[1] or 0)
    counts = answers.where("bundle_id >= 0")

    def cells_of(bundle_id: int, ids: np.ndarray, texts: list[bytes], got: dict[int, bytes]) -> list[tuple]:
        c = _Counts(texts, got, parts, deleted=True)
        sizes = np.diff(c.first)
        p2, p1, _ = c.estimates(n - np.repeat(sizes, sizes), v)
        log = lambda p: np.where(p > 0, np.round(np.log2(np.where(p > 0, p, 1)) * _STEPS), _ABSENT).astype(np.int64)
        cells, times = np.unique(np.stack([_bucket(c.context), log(p2), log(p1)], axis=1), axis=0, return_counts=True)
        return [(*row, t) for row, t in zip(cells.tolist(), times.tolist())]

    training = kinds[0]
    cell_schema = pa.schema([(c, pa.int64()) for c in ("bucket", "two", "one", "n")])
    own_counts = counts.join(training.select("bundle_id"), "bundle_id", "left_semi").select(*[c.split()[0] for c in ANSWER.split(", ")])
    cells = meet(training, own_counts, cells_of, cell_schema, "bucket long, two long, one long, n long")
    # A bounded number of cells, whatever the corpus: buckets times two ranges of logarithms.
    found = cells.groupBy("bucket", "two", "one").agg(F.sum("n")).collect()
    weights = learn_weights([tuple(r) for r in found], 1.0 / (v + 1))

    def score(bundle_id: int, ids: np.ndarray, texts: list[bytes], got: dict[int, bytes]) -> list[tuple]:
        c = _Counts(texts, got, parts)
        p2, p1, p0 = c.estimates(n, v)
        w = weights[_bucket(c.context)]
        model = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * p0)
        base = np.log10((c.word + 1) / (n + v + 1))
        cut = c.first[:-1]
        known = np.add.reduceat((c.word > 0).astype(np.int64), cut)
        cols = [ids.tolist(), held_out(ids).astype(bool).tolist(), np.diff(c.first).tolist(), known.tolist(), [int(n)] * len(ids), np.add.reduceat(base, cut).tolist(), np.add.reduceat(model, cut).tolist()]
        return list(zip(*cols))

    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    return meet(bundles, counts, score, schema, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
