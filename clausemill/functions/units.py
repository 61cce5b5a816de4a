"""Building-code units as column expressions: references, types, codes, anchors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: Clause references, most specific first; a text's reference is the first match of the first pattern that matches.
REFERENCES = [r"(?i)(?<!\w)([A-Z]\d+[A-Z]\d+[a-z])(?!\w)", r"(?i)(?<!\w)([A-Z]\d+[A-Z]\d+)(?!\w)", r"(?i)(?<!\w)([A-Z]\d+\.\d+)(?!\w)", r"(?i)(?<!\w)([A-Z]\d+)(?!\w)"]
_SEPARATOR = r"^\s*[–—:.-]?\s*"


def first_of(c: Column, patterns: list[str], group: int = 1) -> Column:
    """The first match of the first pattern that has one, else ''."""
    return F.coalesce(*[F.nullif(F.regexp_extract(c, p, group), F.lit("")) for p in patterns], F.lit(""))


def volume_label(c: Column) -> Column:
    """U-2."""
    return F.concat(F.lit("Vol"), F.upper(F.regexp_replace(c, "(?i)^Vol", "")))


def clause_ref(text: Column) -> Column:
    """U-3. Most texts have no letter before a digit, which every reference has, and are read once; the first two patterns run
    where another letter and digit follow, the third where there is a stop."""
    labels, numbers, parts = REFERENCES[:2], REFERENCES[2:3], REFERENCES[3:]
    several = F.when(text.rlike(r"[A-Za-z]\d+[A-Za-z]\d"), F.nullif(first_of(text, labels), F.lit("")))
    numbered = F.when(F.contains(text, F.lit(".")), F.nullif(first_of(text, numbers), F.lit("")))
    return F.when(text.rlike(r"[A-Za-z]\d"), F.upper(F.coalesce(several, numbered, first_of(text, parts)))).otherwise("")


def heading_level(tag: Column) -> Column:
    """U-6."""
    return F.when(F.lower(tag).rlike("^h[1-6]$"), F.upper(tag)).otherwise("")


def heading_text(text: Column, ref: Column, at_word: bool = False) -> Column:
    """U-7: after the reference, the first sentence of at most 150 characters, else the first line cut to 100; V-28 cuts
    it at a word. References are compared as text, so no pattern depends on data."""
    starts = F.startswith(text, ref) & (ref != "")
    after = F.when(starts, F.regexp_replace(F.substring(text, F.length(ref) + 1, F.length(text)), _SEPARATOR, "")).otherwise(text)
    after = strip(after)
    sentence = strip(F.regexp_extract(after, r"^([^.!?]+[.!?])(?:\s|\z)", 1))
    line = strip(F.regexp_extract(after, r"^([^\n]*)", 1))
    short = F.regexp_extract(line, r"^(.{1,100})(?:\s|\z)", 1) if at_word else F.substring(line, 1, 100)
    return F.when((sentence != "") & (F.length(sentence) <= 150), sentence).when(F.length(line) <= 100, line).otherwise(short)


def unit_type(text: Column) -> Column:
    """U-13: an ordered cascade over the text. A pattern runs where its letter or word is, which is looked for as bytes."""
    low = F.lower(text)
    has = lambda s: F.contains(low, F.lit(s))
    matches = lambda p, word: F.contains(text, F.lit(word)) & text.rlike(p)
    return (
        F.when(matches(r"^P\d+|P\d+\.\d+|P\d+[A-Z]\d+", "P") | has("performance requirement"), "PERFORMANCE_REQUIREMENT")
        .when(has("deemed-to-satisfy") | has("deemed to satisfy") | has("dts") | matches(r"^D\d+|D\d+\.\d+", "D"), "DTS_PROVISION")
        .when(has("verification method") | matches(r"^V\d+|V\d+\.\d+", "V"), "VERIFICATION_METHOD")
        .when(has("evidence of suitability"), "EVIDENCE_OF_SUITABILITY")
        .when(has("definition") | matches("^[A-Z][^—]+—", "—") | matches("^[A-Z][^means]+means", "means"), "DEFINITION")
        .otherwise("OTHER")
    )


#: Fixed values, U-14: the letter before the last number of a label.
LABEL_TYPES = {"G": "GOVERNING_REQUIREMENT", "O": "OBJECTIVE", "F": "FUNCTIONAL_STATEMENT", "P": "PERFORMANCE_REQUIREMENT", "D": "DTS_PROVISION", "V": "VERIFICATION_METHOD"}


def label_type(label: Column, default: str | Column = "OTHER") -> Column:
    letter = F.regexp_extract(label, r"^[A-Z]\d+([A-Z])\d+", 1)
    types = F.create_map(*[F.lit(x) for pair in LABEL_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(types, letter), default if isinstance(default, Column) else F.lit(default))


def bare_ref(ref: Column) -> Column:
    """Without a leading "table"."""
    return strip(F.regexp_replace(ref, r"(?i)^table\s+", ""))


#: What follows a reference's section, and its part: C1F1, P2.1 or C1.
_SECTION = r"^([A-Z])\d+(?:[A-Z]\d+[a-zA-Z]?\z|\.\d+|\z)"
_PART = r"^([A-Z]\d+)(?:[A-Z]\d+[a-zA-Z]?\z|\.\d+|\z)"


def section_code(ref: Column) -> Column:
    """U-15: C1F1 and P2.1 to C and P."""
    return F.coalesce(F.regexp_extract(bare_ref(ref), _SECTION, 1), F.lit(""))


def part_code(ref: Column) -> Column:
    """U-15: C1F1 and P2.1 to C1 and P2."""
    return F.coalesce(F.regexp_extract(bare_ref(ref), _PART, 1), F.lit(""))


def with_fallback(own: Column, other: Column) -> Column:
    """U-16: the second where the first is empty."""
    return F.when(own != "", own).otherwise(other)


def paragraph_range(location: Column) -> tuple[Column, Column]:
    """U-17: the two numbers of para_i_to_j, else 0 and 0; a number that is no int is 0 too. What is not there is not cast: a
    cast that fails is an exception within Spark, which takes longer than the rest of a row."""
    number = lambda k: F.coalesce(F.nullif(F.regexp_extract(location, r"para_(\d+)_to_(\d+)", k), F.lit("")).try_cast("int"), F.lit(0))
    return number(1), number(2)


def anchor_id(ref: Column, volume: Column) -> Column:
    """U-18."""
    return F.when(F.coalesce(ref, F.lit("")) == "", "").otherwise(F.concat(F.regexp_replace(F.upper(volume), r"\s+", "_"), F.lit("::"), bare_ref(ref)))


def normative_status(kind: Column) -> Column:
    """U-19."""
    return F.when(kind.isin("PERFORMANCE_REQUIREMENT", "DTS_PROVISION", "VERIFICATION_METHOD"), "NORMATIVE").otherwise("INFORMATIVE")


def pathway(kind: Column) -> Column:
    """U-20."""
    return F.when(kind == "PERFORMANCE_REQUIREMENT", "PERFORMANCE").when(kind == "DTS_PROVISION", "DTS").when(kind == "VERIFICATION_METHOD", "VERIFICATION").otherwise("OBJECTIVE")


def compliance_weight(kind: Column) -> Column:
    """U-21."""
    return F.when(kind == "PERFORMANCE_REQUIREMENT", "MANDATORY").when(kind.isin("DTS_PROVISION", "VERIFICATION_METHOD"), "OPTIONAL_PATHWAY").otherwise("NON_MANDATORY")


def contains_word(text: Column, word: str) -> Column:
    """U-22: a substring, whatever the case."""
    return F.contains(F.lower(text), F.lit(word))


def is_table_id(c: Column) -> Column:
    """U-24."""
    return strip(c).rlike(r"^[A-Z]\d+[A-Z]\d+[a-zA-Z]?\z|^[A-Z]\d+\.\d+\z")


def clause_part_code(ref: Column) -> Column:
    """J-2: the last letter and number, for routing: A5G1 to G1, P2.1 to P2. Only lower-case suffixes belong to it."""
    return first_of(bare_ref(ref), [r"^[A-Z]\d+([A-Z]\d+[a-z]?)\z", r"[A-Z]\d+([A-Z])\z", r"^([A-Z]\d+)\z", r"^([A-Z]\d+)\."])
