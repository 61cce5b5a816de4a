"""Clause detection, segmentation and editing over (doc_id, para_idx, text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.text import strip

from .scans import CHUNK, running

#: Headings, units and first words of notes. Numeric 2.6.3, lettered E2.2a, or appendix A.1 numbers, with an optional (a) or (iv), then separators and text.
HEADING = r"^\s*((?:\d+(?:\.\d+){1,4})|(?:[A-Z]{1,2}\d+(?:\.\d+)*[a-z]?)|(?:[A-Z]\.\d+(?:\.\d+){0,3}))(\([a-zivx]+\))?\s*[ .\-–:]*\s*(.*)$"
_UNITS = "kW|W|A|V|Hz|mm|kg|m|cm|km|MHz|GHz"
#: What a note's first words say it is.
NOTE_TYPES = [("note", r"(?i)^(NOTE|NOTES)(?!\w)"), ("exception", r"(?i)^(EXCEPTION|EXCEPT)(?!\w)"), ("warning", r"(?i)^(WARNING|CAUTION)(?!\w)"), ("jurisdiction", r"(?i)^(New Zealand only|NZ only)(?!\w)")]
SUBCLAUSE = r"^\s*\(([a-z]|[ivx]+)\)\s+"


def is_excluded(text: Column) -> Column:
    """C-1: captions of tables and figures, page numbers, quantities, and texts under three characters."""
    t = strip(text)
    # One pattern for what is judged by the whole text, since a filter strips it for each mention.
    starts = rf"(?i)^(?:table|tab\.|tab\s|figure|fig\.|fig\s|\s*page\s+\d+|\d+\.?\d*\s*(?:{_UNITS})\s*$)"
    return t.rlike(starts) | F.substring(t, 1, 20).rlike(rf"(?i)^\d+\.?\d*\s*({_UNITS})(?!\w)") | (F.length(t) < 3)


def is_heading(text: Column) -> Column:
    """C-2, for texts that are not excluded."""
    return text.rlike(HEADING) & ~is_excluded(text)


def clause_number(text: Column) -> Column:
    return F.concat(F.regexp_extract(text, HEADING, 1), F.regexp_extract(text, HEADING, 2))


def clause_text(text: Column) -> Column:
    """C-3: the text after the number, or the whole paragraph where there is none."""
    own = strip(F.regexp_extract(text, HEADING, 3))
    return F.when(own != "", own).otherwise(text)


def clause_id(para_idx: Column, number: Column) -> Column:
    return F.concat(F.lit("clause-"), para_idx.cast("string"), F.lit("-"), number)


def note_type(text: Column) -> Column:
    """C-4: note, exception, warning, jurisdiction or null."""
    out = None
    for name, pattern in NOTE_TYPES:
        hit = strip(text).rlike(pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def headings(paragraphs: DataFrame) -> DataFrame:
    """C-2, C-3: (doc_id, para_idx, clause_number, clause_id, clause_text)."""
    number = clause_number(F.col("text"))
    return paragraphs.where(is_heading(F.col("text"))).select("doc_id", "para_idx", number.alias("clause_number"), clause_id(F.col("para_idx"), number).alias("clause_id"), clause_text(F.col("text")).alias("clause_text"))


def subclauses(paragraphs: DataFrame) -> DataFrame:
    """C-17: lines that are only a lettered or roman item."""
    return paragraphs.where(F.col("text").rlike(SUBCLAUSE)).withColumn("item", F.regexp_extract("text", SUBCLAUSE, 1))


def segments(paragraphs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """C-5, W-1: each paragraph with seg, the number of its clause in the document; 0 is before the first clause."""
    rows = paragraphs.withColumn("is_heading", is_heading(F.col("text")))
    return running(rows, "para_idx", sums={"seg": F.col("is_heading").cast("int")}, chunk=chunk)


def segment_bounds(paragraphs: DataFrame) -> DataFrame:
    """W-2: of each clause the first paragraph and the one before the next clause."""
    last = paragraphs.groupBy("doc_id").agg(F.max("para_idx").alias("last"))
    heads = paragraphs.where(is_heading(F.col("text"))).select("doc_id", "para_idx")
    after = F.lead("para_idx").over(Window.partitionBy("doc_id").orderBy("para_idx"))
    return heads.withColumn("next", after).join(last, "doc_id").select("doc_id", F.col("para_idx").alias("first_para"), F.coalesce(F.col("next") - 1, "last").alias("last_para"))


def clauses(paragraphs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """C-5 to C-7: (doc_id, seg, para_idx, clause_number, clause_id, text, notes, exceptions, warnings, jurisdiction).

    The text joins the heading and the ordinary paragraphs; notes and the like go to arrays, null if empty. Paragraphs
    before a document's first heading are dropped."""
    rows = segments(paragraphs, chunk).where("seg > 0").withColumn("t", strip(F.col("text")))
    kind = F.when(F.col("is_heading"), "heading").otherwise(F.coalesce(note_type(F.col("text")), F.lit("text")))
    item = F.struct("para_idx", kind.alias("kind"), "t", "text")
    grouped = rows.where("is_heading or t <> ''").groupBy("doc_id", "seg").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def of(*kinds: str) -> Column:
        return F.transform(F.filter("items", lambda x: x["kind"].isin(*kinds)), lambda x: x["t"])

    def some(k: str) -> Column:
        return F.when(F.size(of(k)) > 0, of(k)).alias(k + "s" if k != "jurisdiction" else k)

    head = F.element_at("items", 1)
    number = clause_number(head["text"])
    return grouped.select("doc_id", "seg", head["para_idx"].alias("para_idx"), number.alias("clause_number"), clause_id(head["para_idx"], number).alias("clause_id"), F.array_join(of("heading", "text"), " ").alias("text"), some("note"), some("exception"), some("warning"), some("jurisdiction"))


def joined(rows: DataFrame, sep: str = "\n\n") -> DataFrame:
    """C-14: the arrays as text, null where there is nothing."""
    return rows.withColumns({c: F.array_join(c, sep) for c in ("notes", "exceptions", "warnings", "jurisdiction")})


def coverage(rows: DataFrame) -> DataFrame:
    """C-8."""
    return rows.agg(F.count(F.lit(1)).alias("clauses"), F.count("notes").alias("with_notes"), F.count("exceptions").alias("with_exceptions"))


def toggle_marks(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """C-9: ``marks`` (doc_id, para_idx, mark_text, mark_number) over clauses (doc_id, para_idx, clause_id,
    clause_number, text). A mark on a paragraph without clause adds one; on a paragraph with clauses it removes the
    first whose text is the mark's, or begins inside it, and all of them if there is none such."""
    met = rows.join(marks, ["doc_id", "para_idx"])
    t, m = strip(F.col("text")), strip(F.col("mark_text"))
    hit = (m != "") & ((t == m) | F.contains(m, F.substring(t, 1, 50)))
    first = F.min(F.when(hit, F.col("clause_id"))).over(Window.partitionBy("doc_id", "para_idx"))
    gone = met.withColumn("first", first).where(F.col("first").isNull() | (F.col("first") == F.col("clause_id"))).select("doc_id", "clause_id")
    kept = rows.join(gone, ["doc_id", "clause_id"], "left_anti").select("doc_id", "para_idx", "clause_number", "text", F.lit("auto").alias("marked_by"))
    new = marks.join(rows, ["doc_id", "para_idx"], "left_anti").where(strip(F.col("mark_number")) != "")
    return kept.unionByName(new.select("doc_id", "para_idx", strip(F.col("mark_number")).alias("clause_number"), F.col("mark_text").alias("text"), F.lit("manual").alias("marked_by")))


def delete_and_merge(rows: DataFrame, selected: Column, chunk: int = CHUNK) -> DataFrame:
    """C-10, C-11, W-3: selected clauses go; each is appended to the nearest clause before it that stays."""
    gone = rows.withColumn("gone", selected)
    placed = running(gone, "para_idx", lasts={"target": F.when(~F.col("gone"), F.col("para_idx"))}, chunk=chunk)
    piece = F.struct("para_idx", F.when(F.col("gone"), F.concat(F.lit("\n\n"), "clause_number", F.lit(" "), "text")).otherwise(F.col("text")).alias("t"), "clause_number")
    merged = placed.where("target is not null").groupBy("doc_id", "target").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    return merged.select("doc_id", F.col("target").alias("para_idx"), F.element_at("p", 1)["clause_number"].alias("clause_number"), F.array_join(F.transform("p", lambda x: x["t"]), "").alias("text"))


def preview(rows: DataFrame, order: str, k: int = 3) -> DataFrame:
    """C-15: the first k rows and how many more there are."""
    more = rows.agg(F.greatest(F.count(F.lit(1)) - k, F.lit(0)).alias("n_more"))
    return rows.orderBy(order).limit(k).crossJoin(F.broadcast(more))


def large_documents(paragraphs: DataFrame, max_paragraphs: int = 1000, max_bytes: int = 5 << 20) -> DataFrame:
    """C-16: per document, paragraphs, bytes, and whether a preview should be off."""
    sizes = paragraphs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_paragraphs"), F.sum(F.octet_length("text")).alias("n_bytes"))
    return sizes.withColumn("is_large", (F.col("n_paragraphs") > max_paragraphs) | (F.col("n_bytes") > max_bytes))
