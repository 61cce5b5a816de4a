"""Benchmark decontamination: find documents that hold a test item, give or take a few edits.

Method: pigeonhole edit matching. An item of m characters may differ by k = m * error_percent / 100 edits; cut into
k + 1 pieces, at least one piece occurs unchanged in any match. Exact piece hits come from one automaton per block of
items. As k edits over k + 1 pieces in a ring leave some piece from which on any t pieces have at most t - 1 edits, a
hit counts only if the piece after it follows within one edit (the last piece has none after it and always counts).
The windows of these hits are verified with Myers' bit-parallel distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_FROM, LOWER_TO, pick

#: Items are sent to the tasks in blocks of at most so many characters; further blocks are further passes.
BLOCK_CHARS = 8_000_000
_LOWER = str.maketrans(LOWER_FROM, LOWER_TO)
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def normalise(text: str) -> str:
    """A-Z lower-cased, every run of ASCII white space one space, none at the ends."""
    return _SPACE.sub(" ", text).strip(" ").translate(_LOWER)


def within(pattern: str, text: str, budget: int) -> int | None:
    """The least edit distance between ``pattern`` and any substring of ``text`` if it is at most ``budget``: Myers'
    column-wise bit vectors, with a free start and end in the text."""
    m = len(pattern)
    eq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    ones, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = ones, 0, m, m
    for c in text:
        e = eq.get(c, 0)
        x = e | down
        d0 = (((x & up) + up) ^ up) | x
        rise, fall = down | (ones & ~(d0 | up)), up & d0
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
            if score < best:
                best = score
        rise <<= 1
        fall <<= 1
        up, down = (fall | (ones & ~(d0 | rise))) & ones, rise & d0 & ones
    return best if best <= budget else None


def follows(text: str, at: int, piece: str) -> bool:
    """Whether ``piece`` is at place ``at`` of the text, give or take one edit."""
    t, n = text[at : at + len(piece) + 1], len(piece)
    a, end = 0, min(n, len(t))
    while a < end and t[a] == piece[a]:
        a += 1
    return a >= n - 1 or piece[a + 1 :] == t[a + 1 : n] or piece[a + 1 :] == t[a : n - 1] or piece[a:] == t[a + 1 : n + 1]


class Matcher:
    """Piece automaton and verification for one block of items."""

    def __init__(self, items: list[tuple[int, str]], error_percent: int):
        self.items = []
        pieces: dict[str, list[tuple[int, int, str]]] = {}
        for item_id, text in items:
            budget = len(text) * error_percent // 100
            at = [len(text) * j // (budget + 1) for j in range(budget + 2)]
            for a, b, c in zip(at, at[1:], [*at[2:], at[-1]]):
                pieces.setdefault(text[a:b], []).append((len(self.items), a, text[b:c]))
            self.items.append((item_id, text, budget))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """Least distance of each item that the text holds, by item id."""
        found: dict[int, int] = {}
        tried: set[tuple[int, int]] = set()
        if not self.items:
            return found
        for end, (size, where) in self.automaton.iter(text):
            for k, offset, after in where:
                if after and not follows(text, end + 1, after):
                    continue
                item_id, item, budget = self.items[k]
                if not budget:  # the piece is the item
                    found[item_id] = 0
                    continue
                start = end + 1 - size - offset
                slot = start // (2 * budget + 8)
                if (k, slot) in tried:
                    continue
                tried.add((k, slot))
                low = slot * (2 * budget + 8) - budget
                d = within(item, text[max(0, low) : low + len(item) + 4 * budget + 8], budget)
                if d is not None and d <= found.get(item_id, budget):
                    found[item_id] = d
        return found


def find_items(docs: DataFrame, items: DataFrame, error_percent: int = 10, min_chars: int = 1) -> DataFrame:
    """(doc_id, n_items, item_ids, distances, contaminated), a row per document.

    ``docs`` has doc_id and text; ``items`` has item_id and text. Both are compared with A-Z lower-cased and
    white space collapsed. A document holds an item if some stretch of it is within error_percent percent of the
    item's characters, counted in edits. item_ids ascend; distances are in their order. Null and blank items are ignored,
    and with a larger ``min_chars`` shorter ones; an item under ten characters must occur exactly; a null text holds
    nothing. Repeated items are reported once each. Rows that repeat a doc_id are judged each by their own text. Other
    columns are ignored. An empty table of documents gives
    no rows; an empty benchmark leaves all documents clean. Memory follows the longest text.
    """
    min_chars = max(1, min_chars)
    tests = pick(items, "item_id", "text").where(F.length("text") >= min_chars)
    chars = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS) or 1
    rows = pick(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = None
    for block in range(blocks):
        mine = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else tests
        part = _find_block(rows, sorted((r[0], normalise(r[1])) for r in mine.collect()), error_percent, min_chars)
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        pair = F.explode(F.arrays_zip("item_ids", "distances")).alias("x")
        hits = found.select("doc_id", "text_hash", pair).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("x")).alias("x"))
        found = rows.drop("text").join(hits.hint("merge"), ["doc_id", "text_hash"], "left").select("doc_id", *[F.coalesce(F.col(f"x.{c}"), F.array().cast(t)).alias(c) for c, t in (("item_ids", "array<long>"), ("distances", "array<int>"))])
    return found.select("doc_id", F.size("item_ids").cast("long").alias("n_items"), "item_ids", "distances", (F.size("item_ids") > 0).alias("contaminated"))


def _find_block(rows: DataFrame, items: list[tuple[int, str]], error_percent: int, min_chars: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast([x for x in items if len(x[1]) >= min_chars])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value, error_percent)
        for b in batches:
            found = [matcher.find(normalise(t.as_py() or "")) for t in b.column(2)]
            ids = pa.array([sorted(f) for f in found], pa.list_(pa.int64()))
            distances = pa.array([[f[k] for k in sorted(f)] for f in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), ids, distances], ["doc_id", "text_hash", "item_ids", "distances"])

    return rows.mapInArrow(run, "doc_id long, text_hash long, item_ids array<long>, distances array<int>")
