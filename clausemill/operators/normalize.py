"""Clause tables from spreadsheets: numbers repaired, headings split off, hierarchy and ids made."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.text import collapse, strip

SHEET_COLUMNS = ["clause_number", "clause_text", "notes", "exceptions", "warnings", "jurisdiction"]
#: Columns of the clean table, in the order of the sink.
CLEAN_COLUMNS = ["id", "clause_number", "heading", "body", "notes", "exceptions", "level", "parent_number", "parent_id", "appendix_flag", "embeddable", "is_heading_only", "had_duplicate_merge", "source_rows"]
_AMBIGUOUS = r"(\d+(?:\.\d+){2,}),(\d+(?:\.\d+){2,})"


def bare_number(c: Column) -> Column:
    """N-1: without a leading "Clause", white space collapsed."""
    return collapse(F.regexp_replace(strip(c), r"(?i)^Clause\s+", ""))


def join_single(c: Column) -> Column:
    """N-2: 4.4,2 to 4.4.2; a comma before a number that has no dot after it."""
    return F.regexp_replace(c, r"(\d+\.\d+),(\d+)(?!\.)", "$1.$2")


def join_deep(c: Column) -> Column:
    """N-3: 8.3,1.3.3 to 8.3.1.3.3."""
    return F.regexp_replace(c, r"(\d+(?:\.\d+)+),(\d+\.\d+)", "$1.$2")


def clause_number(c: Column) -> Column:
    return join_deep(join_single(bare_number(c)))


def corruption_note(number: Column) -> Column:
    """N-4: on a repaired number, a note of the last comma between two long numbers that do not continue each other."""
    hits = F.filter(F.regexp_extract_all(number, F.lit(_AMBIGUOUS), F.lit(0)), lambda m: F.regexp_extract(m, r"(\d+),", 1).cast("long") != F.regexp_extract(m, r",(\d+)", 1).cast("long"))
    return F.when(F.size(hits) > 0, F.concat(F.lit("POSSIBLE OCR CLAUSE CORRUPTION: "), F.element_at(hits, -1))).otherwise("")


def heading_and_body(text: Column, number: Column) -> tuple[Column, Column]:
    """N-5: the first line is the heading if the number stands before it, or if it is in capitals or title case, and is
    at most 120 characters; the body is the other lines, or the whole text."""
    whole = strip(text)
    lines = F.filter(F.transform(F.split(whole, "\n"), strip), lambda x: x != "")
    first = F.coalesce(F.get(lines, F.lit(0)), F.lit(""))
    rest = F.substring(first, F.length(number) + 1, F.length(first))
    numbered = (F.lower(F.substring(first, F.lit(1), F.length(number))) == F.lower(number)) & rest.rlike(r"^\s+.")
    own = strip(rest)
    titled = (first != "") & ((first == F.upper(first)) | first.rlike(r"^[A-Z][a-z]+(\s+[A-Z][a-z]+)*\z"))
    heading = F.when(numbered & (F.length(own) <= 120), own).when(titled & (F.length(first) <= 120), first).otherwise("")
    others = F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), "\n")
    return heading, F.when((heading != "") & (others != ""), others).otherwise(whole)


def level(number: Column) -> Column:
    """N-6: dot-separated parts, a trailing (a) aside."""
    return F.size(_parts(number))


def _parts(number: Column) -> Column:
    clean = strip(F.regexp_replace(number, r"(?i)\s*\([a-zivx]+\)\s*\z", ""))
    return F.filter(F.split(clean, r"\."), lambda p: p != "")


def parent_number(number: Column) -> Column:
    parts = _parts(number)
    return F.when(F.size(parts) > 1, F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), ".")).otherwise("")


def is_appendix(number: Column) -> Column:
    """N-7."""
    return strip(number).rlike(r"^[A-Z](?:\.\d+|\d+|\z)")


def merged_notes(notes: Column, warnings: Column, jurisdiction: Column, corruption: Column) -> Column:
    """N-10."""
    some = lambda c, front="": F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(front), c))
    return F.concat_ws("\n\n", some(notes), some(warnings, "WARNING: "), some(jurisdiction, "JURISDICTION: "), some(corruption))


def clean_clauses(sheet: DataFrame, standard: str | Column, order: str = "idx") -> DataFrame:
    """N-1 to N-12: the 14-column clause table of a sheet with SHEET_COLUMNS and a row order. ``standard`` names the
    standard of all rows, or is a column with that of each. Rows without a number are left out; the second and later
    clauses of a standard and number get #2, #3, ... in their id."""
    named = F.lit(standard) if isinstance(standard, str) else standard
    own = F.concat(named, F.lit(":"))
    filled = sheet.na.fill("", [c for c in SHEET_COLUMNS if c in sheet.columns])
    rows = filled.withColumn("number", clause_number(F.col("clause_number"))).where("number <> ''")
    nth = F.row_number().over(Window.partitionBy(named, "number").orderBy(order))
    heading, body = heading_and_body(F.col("clause_text"), F.col("number"))
    parent = parent_number(F.col("number"))
    return rows.withColumn("nth", nth).select(
        F.concat(own, "number", F.when(F.col("nth") > 1, F.concat(F.lit("#"), F.col("nth").cast("string"))).otherwise("")).alias("id"),
        F.col("number").alias("clause_number"),
        heading.alias("heading"),
        body.alias("body"),
        merged_notes(F.col("notes"), F.col("warnings"), F.col("jurisdiction"), corruption_note(F.col("number"))).alias("notes"),
        "exceptions",
        level(F.col("number")).alias("level"),
        parent.alias("parent_number"),
        F.when(parent != "", F.concat(own, parent)).otherwise("").alias("parent_id"),
        is_appendix(F.col("number")).alias("appendix_flag"),
        F.lit(True).alias("embeddable"),
        (strip(body) == "").alias("is_heading_only"),
        F.lit(False).alias("had_duplicate_merge"),
        F.concat(F.lit("["), F.col(order).cast("string"), F.lit("]")).alias("source_rows"),
    )


def children(clean: DataFrame) -> DataFrame:
    """N-13: (parent_id, id, level) of every clause whose parent is in the table."""
    parents = clean.select(F.col("id").alias("parent_id"))
    return clean.where("parent_id <> ''").join(parents, "parent_id", "left_semi").select("parent_id", "id", "level")


def orphans(clean: DataFrame) -> DataFrame:
    """N-13: clauses whose parent is missing."""
    return clean.where("parent_id <> ''").join(clean.select(F.col("id").alias("parent_id")), "parent_id", "left_anti").select("id", "parent_id")
