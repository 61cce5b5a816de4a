"""Phrase collocation mining: word sequences that occur often, and more often than their parts suggest.

Method: direct-address tiling. Words get ids by falling frequency, so that the low ids make most of the text. A pair of
neighbouring ids is a cell of a square, which is cut into tiles of TILE by TILE cells. A bundle of documents counts its
pairs tile by tile: a tile with many pairs by one dense ``bincount`` over its cells, all the sparse ones together as a
sorted list of cells (COO). Each bundle sends every cell once, with its count, to the part that owns the tile, where
counts are added the same way, first within some of the bundles, then over all. The frequent pairs get ids by falling
frequency in turn, the text is rewritten in them, and pairs of neighbouring pairs are phrases of one word more: the same
step counts them, level by level. A phrase can only be frequent if the phrases of one word less in it are, so nothing is
lost. Words and phrases of all languages share the ids; no pair crosses a piece, a text or a language.

Scores, containment and ranks are DataFrame joins over the tables of frequent phrases.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _LOWER, REQUEST_ARROW, bundles_and_parts, cuts_by_part, forget, joined, materialize, mix64, pack, part_of, planes, read_bundle, span_hashes, unpack

TILE_BITS = 8
_CELL_BITS = np.uint64(2 * TILE_BITS)
CELLS = 1 << 2 * TILE_BITS
#: Pairs from which on a tile is counted densely.
DENSE = CELLS // 16
_TOTALS = -1
#: Shares in which a language's candidates are ranked first.
_SHARES = 64
#: Bytes that end a piece, and those that only end a word.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(PIECE_ENDS)] = 2
_ASKED = "part int, bundle_id long, blob binary"
_CODED = "bundle_id long, symbols binary"
_CODED_ARROW = pa.schema([("bundle_id", pa.int64()), ("symbols", pa.binary())])


# ---------------------------------------------------------------- words and symbols of a bundle


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes of all texts, where words start and end, whether a piece starts with the word, and its text."""
    buf = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    kind = _KIND[buf]
    edge = np.diff((kind == 0).view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
    text_at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return buf, starts, ends, np.diff(piece, prepend=-1) != 0, np.searchsorted(text_at, starts, side="right") - 1


def word_keys(texts: list[bytes], langs: np.ndarray) -> tuple[np.ndarray, ...]:
    """``split_words`` and a 64-bit key of each word in its text's language."""
    buf, starts, ends, fresh, owner = split_words(texts)
    lang = langs.view(np.uint64)[owner]
    return buf, starts, ends, fresh, lang, mix64(span_hashes(buf, starts, ends) + mix64(lang))


def _write(symbols: np.ndarray) -> bytes:
    """Symbols, bytes of the same place together, as these compress best."""
    return pack(*np.ascontiguousarray(symbols.astype(np.uint32).view(np.uint8).reshape(-1, 4).T))


def _read(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.stack(unpack(blob), axis=1)).view(np.uint32).ravel()


def pair_codes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two symbols follow each other, and the cell of each such pair: its tile, then its place in the tile."""
    at = np.flatnonzero((symbols[:-1] > 0) & (symbols[1:] > 0))
    left, right = symbols[at].astype(np.uint64) - np.uint64(1), symbols[at + 1].astype(np.uint64) - np.uint64(1)
    low, bits = np.uint64((1 << TILE_BITS) - 1), np.uint64(TILE_BITS)
    tile = (left >> bits) << np.uint64(24) | (right >> bits)
    return at, tile << _CELL_BITS | (left & low) << bits | (right & low)


def ids_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two ids of each cell."""
    tile, bits, low = codes >> _CELL_BITS, np.uint64(TILE_BITS), np.uint64((1 << TILE_BITS) - 1)
    left = (tile >> np.uint64(24)) << bits | (codes >> bits) & low
    right = (tile & np.uint64((1 << 24) - 1)) << bits | codes & low
    return left.astype(np.int64), right.astype(np.int64)


def count_cells(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different cells in order and how often each occurs, or the sums of their counts. Tiles with at least DENSE
    entries are counted densely, the others as one sorted list. Sums are exact below 2**53."""
    tile, which = np.unique(codes >> _CELL_BITS, return_inverse=True)
    which = which.astype(np.uint16 if len(tile) <= 1 << 16 else np.int64)  # short keys sort by radix
    size = np.bincount(which, minlength=len(tile))
    order = np.argsort(which, kind="stable")
    end = np.cumsum(size)
    found, sums = [], []
    for k in np.flatnonzero(size >= DENSE).tolist():
        mine = order[end[k] - size[k] : end[k]]
        cells = np.bincount((codes[mine] & np.uint64(CELLS - 1)).astype(np.int64), None if counts is None else counts[mine], CELLS)
        used = np.flatnonzero(cells)
        found.append(tile[k] << _CELL_BITS | used.astype(np.uint64))
        sums.append(cells[used].astype(np.int64))
    rest = np.flatnonzero((size < DENSE)[which])
    by_cell = rest[np.argsort(codes[rest], kind="stable")]
    sparse = codes[by_cell]
    first = np.flatnonzero(np.append(True, sparse[1:] != sparse[:-1])) if len(sparse) else np.zeros(0, np.int64)
    found.append(sparse[first])
    sums.append(np.diff(np.append(first, len(sparse))) if counts is None else np.add.reduceat(counts[by_cell], first) if len(first) else np.zeros(0, np.int64))
    out, total = np.concatenate(found), np.concatenate(sums).astype(np.int64)
    order = np.argsort(out, kind="stable")
    return out[order], total[order]


def _dealt(keys: np.ndarray, parts: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by part, and by key within it, of ascending keys; and the parts in that order."""
    part = part_of(hashes, parts)
    order = np.argsort(part, kind="stable")
    return order, part[order]


def _cells_dealt(symbols: np.ndarray, parts: int) -> tuple[np.ndarray, ...]:
    """Where pairs are, which different cell each is, and the different cells and their counts by part."""
    at, codes = pair_codes(symbols)
    cells, counts = count_cells(codes)
    order, part = _dealt(cells, parts, mix64(cells >> _CELL_BITS))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return at, place[np.searchsorted(cells, codes)], cells[order], counts[order], part


def _words_dealt(ids: np.ndarray, texts: list[bytes], parts: int) -> tuple[np.ndarray, ...]:
    """Bytes, spans and languages of the words, which different word each is, and the different ones by part."""
    buf, starts, ends, fresh, lang, keys = word_keys(texts, ids)
    different, first, which, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return buf, starts, ends, fresh, lang, which, different, first, counts, part_of(different, parts)


# ---------------------------------------------------------------- Spark steps


def _each(rows: DataFrame, make: Callable[[dict], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """(part, bundle_id, blob) from ``make`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                made = list(make(r))
                cols = [pa.array([p for p, _ in made], pa.int32()), pa.array([r["bundle_id"]] * len(made), pa.int64()), pa.array([x for _, x in made], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, schema=REQUEST_ARROW)

    return rows.mapInArrow(run, _ASKED)


def _ask_words(bundles: DataFrame, parts: int) -> DataFrame:
    """Each bundle's different words with counts, languages and bytes, by part; and its words by language."""

    def make(r: dict) -> Iterator[tuple[int, bytes]]:
        buf, starts, ends, _, lang, _, keys, first, counts, part = _words_dealt(*read_bundle(r["doc_ids"], r["sizes"], r["texts"]), parts)
        raw, s, e = buf.tobytes(), starts[first], ends[first]
        for p, a, b in cuts_by_part(part):
            words = b"".join([raw[x:y] for x, y in zip(s[a:b].tolist(), e[a:b].tolist())])
            yield p, pack(*planes(keys[a:b], 8), counts[a:b], lang[first[a:b]], (e - s)[a:b], np.frombuffer(words, np.uint8))
        yield _TOTALS, pack(*np.unique(lang, return_counts=True))

    return _each(bundles.select("bundle_id", "doc_ids", "sizes", "texts"), make)


def _ask_cells(coded: DataFrame, parts: int) -> DataFrame:
    """Each bundle's different cells with counts, by part."""

    def make(r: dict) -> Iterator[tuple[int, bytes]]:
        _, _, cells, counts, part = _cells_dealt(_read(r["symbols"]), parts)
        for p, a, b in cuts_by_part(part):
            yield p, pack(*planes(cells[a:b], 8), counts[a:b])

    return _each(coded, make)


def _word_totals(asked: DataFrame, min_count: int) -> DataFrame:
    """(part, key, f, lang, word) of the words with at least ``min_count`` occurrences."""
    schema = pa.schema([("part", pa.int32()), ("key", pa.int64()), ("f", pa.int64()), ("lang", pa.int64()), ("word", pa.string())])

    def run(table: pa.Table) -> pa.Table:
        out = []
        rows = [unpack(b) for b in table.column("blob").to_pylist()]
        keys, counts = np.concatenate([joined(r[:8]) for r in rows]), np.concatenate([r[8] for r in rows])
        unique, first, which = np.unique(keys, return_index=True, return_inverse=True)
        total = np.zeros(len(unique), dtype=np.int64)
        np.add.at(total, which, counts)
        often = np.flatnonzero(total >= min_count)
        # The bytes of each word from the blob that has it first.
        blob_at = np.cumsum([0, *(len(r[8]) for r in rows)])
        owner = np.searchsorted(blob_at, first[often], side="right") - 1
        spans = [(np.cumsum(r[10]) - r[10], r[10], r[11].tobytes()) for r in rows]
        for k, o in zip(often.tolist(), owner.tolist()):
            i = int(first[k] - blob_at[o])
            begin, size, raw = spans[o]
            out.append((int(unique[k].view(np.int64)), int(total[k]), int(rows[o][9][i].view(np.int64)), raw[int(begin[i]) : int(begin[i] + size[i])].decode("utf-8", "replace")))
        cols = list(zip(*out)) or [()] * 4
        return pa.table([pa.array([table.column("part")[0].as_py()] * len(out), pa.int32()), *[pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])]], schema=schema)

    return asked.where(F.col("part") >= 0).groupBy("part").applyInArrow(run, "part int, key long, f long, lang long, word string")


def _cell_totals(asked: DataFrame, salts: int, min_count: int) -> DataFrame:
    """(part, key, f, left, right) of the cells with at least ``min_count`` occurrences. Counts are added within some of the
    bundles first, so that the tile of the most frequent words is no single task's."""
    partial = pa.schema([("part", pa.int32()), ("blob", pa.binary())])
    schema = pa.schema([(n, pa.int32() if n == "part" else pa.int64()) for n in ("part", "key", "f", "left", "right")])

    def add(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        rows = [unpack(b) for b in table.column("blob").to_pylist()]
        return count_cells(np.concatenate([joined(r[:8]) for r in rows]), np.concatenate([r[8] for r in rows]))

    def some(table: pa.Table) -> pa.Table:
        cells, counts = add(table)
        return pa.table([table.column("part").slice(0, 1), pa.array([pack(*planes(cells, 8), counts)], pa.binary())], schema=partial)

    def run(table: pa.Table) -> pa.Table:
        cells, counts = add(table)
        often = counts >= min_count
        cells, counts = cells[often], counts[often]
        return pa.table([pa.array([table.column("part")[0].as_py()] * len(cells), pa.int32()), *[pa.array(c) for c in (cells.view(np.int64), counts, *ids_of(cells))]], schema=schema)

    by_salt = asked.groupBy("part", F.pmod("bundle_id", F.lit(salts)).alias("salt")).applyInArrow(some, "part int, blob binary")
    return by_salt.groupBy("part").applyInArrow(run, "part int, key long, f long, left long, right long")


def ranked(table: DataFrame, *tie: str) -> DataFrame:
    """The rows with id, their place from 0 on by falling f, written. Spark's range partitioner deals them; the places
    before a partition are the sizes of those before it, a number each."""
    spark = table.sparkSession
    order = [F.col("f").desc(), *[F.col(t) for t in tie]]
    rows = materialize(table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    range_of = F.shiftright("at", 33)
    sizes = sorted(rows.groupBy(range_of.alias("range")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []
    for r, n in sizes:
        starts.append((r, before))
        before += n
    if before >= 1 << 32:
        raise OverflowError("more than 2**32 frequent phrases of one length")
    starts = F.broadcast(spark.createDataFrame(starts, "range long, before long"))
    out = rows.withColumn("range", range_of).join(starts, "range").withColumn("id", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1))
    out = materialize(out.drop("at", "range", "before"))
    forget(rows)
    return out


def _answers(asked: DataFrame, table: DataFrame, salts: int) -> DataFrame:
    """(bundle_id, part, blob): for each bundle and part, 1 + the id of each key asked for, or 0. ``table`` has part, key, id."""
    schema = pa.schema([("bundle_id", pa.int64()), ("part", pa.int32()), ("blob", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, ids = right.column("key").to_numpy().view(np.uint64), right.column("id").to_numpy()
        order = np.argsort(keys)
        keys, ids = np.append(keys[order], np.uint64(0)), np.append(ids[order] + 1, 0)
        out = []
        for blob in left.column("blob").to_pylist():
            mine = joined(unpack(blob)[:8])
            at = np.searchsorted(keys[:-1], mine)
            out.append(pack(np.where(keys[at] == mine, ids[at], 0).astype(np.uint32)))
        return pa.table([left.column("bundle_id"), left.column("part"), pa.array(out, pa.binary())], schema=schema)

    salt = F.pmod("bundle_id", F.lit(salts)).alias("salt")
    known = table.select("part", "key", "id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("known_salt"))
    return asked.where(F.col("part") >= 0).select("part", salt, "bundle_id", "blob").groupBy("part", "salt").cogroup(known.groupBy("part", "known_salt")).applyInArrow(run, "bundle_id long, part int, blob binary")


def _met(rows: DataFrame, answers: DataFrame, use: Callable[[dict, np.ndarray], np.ndarray]) -> DataFrame:
    """(bundle_id, symbols): ``use(row, ids)`` of each row and the ids that it asked for, by part."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = dict(zip(right.column("part").to_pylist(), right.column("blob").to_pylist()))
        ids = np.concatenate([np.zeros(0, np.uint32), *[unpack(got[p])[0] for p in sorted(got)]])
        out = [(r["bundle_id"], _write(use(r, ids))) for r in left.to_pylist()]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _CODED_ARROW)], schema=_CODED_ARROW) if out else _CODED_ARROW.empty_table()

    return rows.groupBy("bundle_id").cogroup(answers.groupBy("bundle_id")).applyInArrow(run, _CODED)


def _code_words(bundles: DataFrame, answers: DataFrame, parts: int) -> DataFrame:
    """Texts as symbols: 1 + the word's id, 0 for a rare word or the end of a piece."""

    def use(r: dict, ids: np.ndarray) -> np.ndarray:
        _, _, _, fresh, _, which, *_ = _words_dealt(*read_bundle(r["doc_ids"], r["sizes"], r["texts"]), parts)
        at = np.arange(len(which)) + np.cumsum(fresh)
        out = np.zeros(len(which) + int(fresh.sum()) + 1, dtype=np.uint32)
        out[at] = ids[which]
        return out

    return _met(bundles.select("bundle_id", "doc_ids", "sizes", "texts"), answers, use)


def _code_pairs(coded: DataFrame, answers: DataFrame, parts: int) -> DataFrame:
    """Symbols of phrases of one word more, each where it starts."""

    def use(r: dict, ids: np.ndarray) -> np.ndarray:
        symbols = _read(r["symbols"])
        at, which, *_ = _cells_dealt(symbols, parts)
        out = np.zeros(len(symbols), dtype=np.uint32)
        out[at] = ids[which]
        return out

    return _met(coded, answers, use)


def phrase_tables(docs: DataFrame, min_count: int, max_words: int) -> tuple[list[DataFrame], DataFrame]:
    """The frequent phrases of each length, and (lang, n), all words by language. The first table is (id, f, lang, word), the
    others are (id, f, left, right): the ids of the phrase without its last and without its first word. ``docs`` has a
    language key and text; a null text is empty."""
    bundles, parts = bundles_and_parts(docs)
    salts = max(1, isqrt(bundles.count()) // 4)
    asked = materialize(_ask_words(bundles, parts))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob in b.column(0):
                lang, n = unpack(blob.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(lang.view(np.int64)), pa.array(n)], ["lang", "n"])

    n = materialize(asked.where(F.col("part") == _TOTALS).select("blob").mapInArrow(totals, "lang long, n long").groupBy("lang").agg(F.sum("n").alias("n")))
    table = ranked(_word_totals(asked, min_count), "lang", "word")
    answers = materialize(_answers(asked, table, salts))
    coded = materialize(_code_words(bundles, answers, parts))
    forget(asked, answers, bundles)
    out = [table.select("id", "f", "lang", "word")]
    for words in range(2, max_words + 1):
        asked = materialize(_ask_cells(coded, parts))
        table = ranked(_cell_totals(asked, salts, min_count), "left", "right")
        out.append(table.select("id", "f", "left", "right"))
        if words < max_words:
            answers = materialize(_answers(asked, table, salts))
            old, coded = coded, materialize(_code_pairs(coded, answers, parts))
            forget(old, answers)
        forget(asked)
    forget(coded)
    return out, n


def mine_phrases(docs: DataFrame, min_count: int = 30, max_words: int = 4, top: int = 2000, covered_percent: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score), the ``top`` phrases of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and into words at spaces and tabs; a null
    text has none, a null language is ``und``. a counts all occurrences of a phrase within pieces, overlaps included, n all
    words of the language. Candidates are phrases of 2 to ``max_words`` words with a >= ``min_count``. A cut after the first
    k words gives l and r, the counts of both sides, and the score floor(2000000 * a / (l + r)); the lowest counts, the
    least k on ties. A candidate inside a longer one that has at least ``covered_percent`` percent of its occurrences is
    left out. Ranks go by falling score, falling a and the phrase's bytes. Rows without or with repeated ids count like
    others; other columns are ignored; a language without candidates has no rows. Words are told apart by 64-bit hashes.
    """
    lang = F.coalesce(F.col("`lang`").cast("string"), F.lit("und"))
    tables, n = phrase_tables(docs.select(F.xxhash64(lang).alias("doc_id"), F.col("`text`").alias("text")), min_count, max_words)
    names = docs.select(lang.alias("lang")).distinct().select(F.xxhash64("lang").alias("key"), "lang")
    big = lambda c: F.col(c).cast("decimal(38,0)")
    # heads and tails: occurrences of the first and the last 1, 2, ... words.
    level = tables[0].select("id", F.col("f").alias("a"), "lang", F.col("word").alias("phrase"), "word", F.array("f").alias("heads"), F.array("f").alias("tails"))
    found = []
    for k, table in enumerate(tables[1:], 1):
        x = level.select(F.col("id").alias("left"), "lang", "phrase", "heads")
        y = level.select(F.col("id").alias("right"), "word", "tails")
        both = table.join(x, "left").join(y, "right")
        cuts = [F.struct(F.expr(f"cast(2000000 * cast(f as decimal(38,0)) div (cast(heads[{j - 1}] as decimal(38,0)) + tails[{k - j}]) as long)").alias("score"), F.lit(j).alias("k"), F.get("heads", F.lit(j - 1)).alias("l"), F.get("tails", F.lit(k - j)).alias("r")) for j in range(1, k + 1)]
        level = materialize(both.select(
            "id", F.col("f").alias("a"), "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "word",
            F.concat("heads", F.array("f")).alias("heads"), F.concat("tails", F.array("f")).alias("tails"), F.array_min(F.array(*cuts)).alias("cut"),
        ))
        found.append(level.select("id", "lang", "phrase", "a", "cut"))
    kept = None
    for k, rows in enumerate(found):
        if k + 1 < len(found):
            # What a phrase of two words more covers, the one of one word more between them covers too.
            longer = tables[k + 2]
            most = longer.select(F.col("left").alias("id"), "f").unionByName(longer.select(F.col("right").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("most"))
            rows = rows.join(most, "id", "left").where(F.col("most").isNull() | (100 * big("most") < covered_percent * big("a"))).drop("most")
        kept = rows if kept is None else kept.unionByName(rows)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranks = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
    rows = kept.select(F.col("lang").alias("key"), "phrase", "a", "cut.l", "cut.r", "cut.score")
    # The first of each share of a language are ranked against each other: no task sorts a whole language.
    some = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(_SHARES))).withColumn("rank", ranks("key", "share")).where(F.col("rank") <= top)
    best = some.drop("share").withColumn("rank", ranks("key")).where(F.col("rank") <= top)
    return best.join(n.withColumnRenamed("lang", "key"), "key").join(names, "key").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
