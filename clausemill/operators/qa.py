"""Data-quality jobs over units: profiles, hypothesis tests, acceptance verdicts, repairs. White space does not count
as text anywhere here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions import units as U
from clausemill.functions import variations as V
from clausemill.functions.text import WS, collapse, dehyphenate, strip

from .scans import positions

CORE_TYPES = ["PERFORMANCE_REQUIREMENT", "DTS_PROVISION", "SPECIFICATION_CLAUSE"]
#: The unit types of the published specification, in its order, the two more that the coverage map routes to,
#: and the one more that classification gives.
UNIT_TYPES = [
    "VOLUME", "SECTION", "PART", "SUBPART",
    "HEADING", "INTRODUCTION", "INTRODUCTORY_PROVISION", "GOVERNING_REQUIREMENT", "OBJECTIVE", "FUNCTIONAL_STATEMENT",
    "PROVISION", "PERFORMANCE_REQUIREMENT", "DTS_PROVISION", "VERIFICATION_METHOD", "DEFINITION", "APPLICATION",
    "SPECIFICATION", "SPECIFICATION_CLAUSE", "SCHEDULE", "APPENDIX",
    "EXPLANATORY_INFORMATION", "NOTE", "EXCEPTION",
    "STATE_VARIATION", "STATE_VARIATION_AMENDMENT",
    "TABLE", "TABLE_NOTE", "FIGURE",
    "SCOPE_SUMMARY", "SCOPE_VOLUME_SELECTION", "SCOPE_CLASS_APPLICABILITY", "SCOPE_EXCEPTION", "GOVERNANCE_RULE",
    "DISCIPLINE_RULE", "CONDITIONAL_RULE", "PATHWAY_SELECTION", "PATHWAY_COMPLETE", "CALCULATION_RULE", "SIZING_RULE",
    "CONSTANT", "PERFORMANCE_CRITERION", "TABLE_ROW",
    "REFERENCED_DOCUMENT", "TABLE_CELL",
    "OTHER",
    "EVIDENCE_OF_SUITABILITY",
]
#: The published enumerations by column; units that are no variation have no action.
ENUMS = {
    "unit_type": UNIT_TYPES,
    "compliance_weight": ["MANDATORY", "OPTIONAL_PATHWAY", "NON_MANDATORY"],
    "ncc_pathway": ["PERFORMANCE", "DTS", "VERIFICATION", "OBJECTIVE", "FUNCTIONAL"],
    "normative_status": ["NORMATIVE", "INFORMATIVE"],
    "conditionality": ["ALWAYS", "IF_DTS_SELECTED", "IF_PERFORMANCE_SELECTED"],
    "variation_action": ["", "DELETE", "INSERT", "REPLACE", "NOT_APPLICABLE", "AMEND_PART"],
    "asset_type": ["NONE", "IMAGE", "TABLE"],
    "applies_to_volume": ["V1", "V2", "V3", ""],
    "applies_state": ["SA", "NSW", "VIC", "QLD", "WA", "TAS", "ACT", "NT", ""],
}


def blank(c: str | Column) -> Column:
    return strip(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))) == ""


def _n(condition: Column) -> Column:
    return F.count_if(condition)


def missingness(units: DataFrame, *extra: str) -> DataFrame:
    """A-1: per unit type (and extra keys) rows, and those without text, raw text, both, and both but with a title."""
    both = blank("text") & blank("raw_text")
    return units.groupBy(*extra, "unit_type").agg(F.count(F.lit(1)).alias("total_rows"), _n(blank("text")).alias("empty_text"), _n(blank("raw_text")).alias("empty_raw_text"), _n(both).alias("empty_both"), _n(both & ~blank("title")).alias("empty_both_with_title"))


def samples(units: DataFrame, k: int = 5, width: int = 120) -> DataFrame:
    """A-2: the first k rows without text of each type, clipped. Needs a global order: volume, then ord."""
    rows = units.where(blank("text")).withColumn("nth", F.row_number().over(Window.partitionBy("unit_type").orderBy("volume", "ord"))).where(F.col("nth") <= k)
    clip = lambda c: F.substring(collapse(F.col(c)), 1, width)
    shown = F.when(clip("raw_text") == "", "EMPTY").otherwise(clip("raw_text"))
    return rows.select("unit_type", "nth", "unit_label", clip("title").alias("title"), shown.alias("raw_text"))


def worst_types(units: DataFrame, k: int = 5) -> DataFrame:
    """A-3: the k types with most rows without either text, and their rate; ties by name."""
    rows = missingness(units).where("empty_both > 0").select("unit_type", "total_rows", "empty_both", F.round(100 * F.col("empty_both") / F.col("total_rows"), 1).alias("rate"))
    return rows.orderBy(F.desc("empty_both"), "unit_type").limit(k)


def failure_category(text: Column, raw: Column) -> Column:
    """A-5: C without either text, B with raw text only, else UNKNOWN."""
    return F.when(blank(text) & blank(raw), "C").when(blank(text), "B").otherwise("UNKNOWN")


def evidence(units: DataFrame, k: int = 20, worst: int = 5) -> DataFrame:
    """A-4: the first k rows without text of the worst types, with their category."""
    failing = units.where(blank("text")).join(F.broadcast(worst_types(units, worst).select("unit_type")), "unit_type", "left_semi")
    return failing.orderBy("volume", "ord").limit(k).select("volume", "ord", "unit_type", "unit_label", failure_category(F.col("text"), F.col("raw_text")).alias("category"))


def categories(units: DataFrame) -> DataFrame:
    """A-5."""
    return units.groupBy(failure_category(F.col("text"), F.col("raw_text")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


def core_comparison(units: DataFrame, types: list[str], volumes: list[str]) -> DataFrame:
    """A-6, J-8: rows without either text of each core type, a column per volume."""
    both = F.when(blank("text") & blank("raw_text"), 1).otherwise(0)
    return units.where(F.col("unit_type").isin(types)).groupBy("unit_type").pivot("volume", volumes).agg(F.sum(both)).na.fill(0)


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """A-7, J-8: rows without text and without both, before and after, and the improvement in percent."""
    side = lambda df, s: df.groupBy("unit_type").agg(_n(blank("text")).alias(f"empty_text_{s}"), _n(blank("text") & blank("raw_text")).alias(f"empty_both_{s}"))
    rows = side(before, "before").join(side(after, "after"), "unit_type", "full").na.fill(0)
    better = F.when(F.col("empty_text_before") > 0, F.round(100 * (F.col("empty_text_before") - F.col("empty_text_after")) / F.col("empty_text_before"), 1)).otherwise(0.0)
    return rows.withColumn("improvement", better)


def column_emptiness(df: DataFrame) -> DataFrame:
    """A-8: per column, rows that are empty ('', [] or 0; booleans never), their share, and a band, from one pass."""
    empty = {c: F.lit(False) if t == "boolean" else F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")).isin("", "[]", "0") for c, t in df.dtypes}
    counted = df.agg(F.count(F.lit(1)).alias("total"), *[_n(e).alias(c) for c, e in empty.items()])
    pairs = ", ".join(f"'{c}', `{c}`" for c in empty)
    rows = counted.selectExpr("total", f"stack({len(empty)}, {pairs}) as (column_name, empty_rows)")
    share = F.round(100 * F.col("empty_rows") / F.col("total"), 2)
    band = F.when(F.col("empty_rows") == F.col("total"), "100").when(share > 90, ">90").when(share > 50, ">50").otherwise("<=50")
    return rows.select("column_name", "total", "empty_rows", (F.col("total") - F.col("empty_rows")).alias("non_empty_rows"), share.alias("empty_percent"), band.alias("band"))


_IDENTITY = ["applies_to_volume", "section_code", "part_code", "path"]


def _has(c: str) -> Column:
    # One pattern, since a filter works out a column for each mention of it.
    return ~F.coalesce(c, F.lit("")).rlike(rf"^(?:{WS}*| *NaN *)\z")


def identity_coverage(units: DataFrame) -> DataFrame:
    """A-9, Q-8: share of rows with each identity column, and whether every one occurs and some rows are indexable."""
    percent = [F.round(100 * _n(_has(c)) / F.count(F.lit(1)), 1).alias(f"{c}_percent") for c in _IDENTITY]
    verdict = reduce(lambda a, b: a & b, [_n(_has(c)) > 0 for c in _IDENTITY[:3]]) & (_n(F.col("indexable")) > 0)
    return units.agg(*percent, F.round(100 * _n(F.col("indexable")) / F.count(F.lit(1)), 1).alias("indexable_percent"), verdict.alias("passed"))


def identity_samples(units: DataFrame, complete: int = 5, missing: int = 10) -> DataFrame:
    """A-10: the first rows with and without a complete identity."""
    whole = reduce(lambda a, b: a & b, [_has(c) for c in _IDENTITY])
    take = lambda cond, name, k: units.where(cond).orderBy("volume", "ord").limit(k).select(F.lit(name).alias("sample"), "volume", "ord", "unit_label", "section_code", "part_code")
    return take(whole, "complete", complete).unionByName(take(~whole, "missing", missing))


def marker_totals(units: DataFrame) -> DataFrame:
    """A-11, V-7: rows with markers and all markers, where warnings tell of embedded variations."""
    n = F.size(V.markers(F.col("text")))
    return units.where(F.contains("warnings", F.lit("STATE_VARIATION_EMBEDDED"))).agg(_n(n > 0).alias("rows_with_markers"), F.coalesce(F.sum(n), F.lit(0)).alias("markers"))


def distributions(units: DataFrame) -> DataFrame:
    """A-12, O-1: rows by unit type, weight, state and volume, in one table, from one pass."""
    values = {"unit_type": F.col("unit_type"), "weight": U.compliance_weight(F.col("unit_type")), "state": F.col("applies_state"), "volume": F.col("volume")}
    rows = units.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), v.alias("value")) for d, v in values.items()])).alias("x"))
    return rows.groupBy("x.dimension", "x.value").agg(F.count(F.lit(1)).alias("n"))


def labels_by_type(units: DataFrame, chunk: int = 1000) -> DataFrame:
    """A-13: (volume, unit_type, chunk, labels): the different labels of each type in order, ``chunk`` of them to a row. Labels
    are dealt by ranges, so no task holds all of a type."""
    keys = ["volume", "unit_type"]
    placed = positions(units.select(*keys, "unit_label").distinct(), *keys, "unit_label")
    start = placed.groupBy(*keys).agg(F.min("position").alias("start"))
    rows = placed.join(start, keys).withColumn("chunk", F.expr(f"(position - start) div {chunk}"))
    return rows.groupBy(*keys, "chunk").agg(F.array_join(F.array_sort(F.collect_list("unit_label")), ", ").alias("labels"))


def hypotheses(units: DataFrame) -> DataFrame:
    """Q-1, Q-2, A-14: three causes of missing text: rows that fit, label prefixes of these, and a verdict, from one pass."""
    text, raw, title, kind = (collapse(F.coalesce(c, F.lit(""))) for c in ("text", "raw_text", "title", "unit_type"))
    tests = {"H1": V.fix_instruction_only(kind, text, raw), "H2": V.is_unresolved(kind, title, text, raw) & (kind == "FUNCTIONAL_STATEMENT"), "H3": V.is_unresolved(kind, title, text, raw) & (kind == "VERIFICATION_METHOD")}
    prefix = F.regexp_extract("unit_label", r"^([A-Z]\d+)", 1)
    listed = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond & (prefix != ""), prefix))), ",")
    found = units.agg(*[x for h, c in tests.items() for x in (_n(c).alias(f"n_{h}"), listed(c).alias(f"prefixes_{h}"))])
    rows = found.selectExpr(f"stack({len(tests)}, {', '.join(f"'{h}', n_{h}, prefixes_{h}" for h in tests)}) as (hypothesis, n, prefixes)")
    return rows.withColumn("verdict", F.when(F.col("n") > 0, "PROVEN").otherwise("NOT PROVEN"))


def hypothesis_rows(units: DataFrame, k: int = 10) -> DataFrame:
    """Q-1: the first k variations without text that have an instruction."""
    hit = V.fix_instruction_only(F.col("unit_type"), collapse(F.col("text")), collapse(F.col("raw_text")))
    return units.where(hit).orderBy("volume", "ord").limit(k).select("volume", "ord", "unit_label", F.substring(collapse(F.col("raw_text")), 1, 150).alias("raw_text"))


def apply_fixes(units: DataFrame) -> DataFrame:
    """V-5, V-6, O-5: text of instruction-only variations, and the flags of notes_quality."""
    text, raw, title = (collapse(F.col(c)) for c in ("text", "raw_text", "title"))
    f1 = V.fix_instruction_only(F.col("unit_type"), text, raw)
    f2 = V.is_unresolved(F.col("unit_type"), title, text, raw)
    flags = V.flags_of(collapse(F.col("notes_quality")))
    after_1 = F.when(f1, F.array_union(F.array_remove(flags, "MISSING_TEXT"), F.array(F.lit("INSTRUCTION_ONLY_VARIATION")))).otherwise(flags)
    after_2 = F.when(f2, F.array_union(after_1, F.array(F.lit("MISSING_TEXT_UNRESOLVED")))).otherwise(after_1)
    return units.withColumns({"notes_quality": F.array_join(F.array_distinct(after_2), "|"), "text": F.when(f1, collapse(dehyphenate(F.col("raw_text")))).otherwise(text), "f1_fixed": f1, "f2_unresolved": f2})


def acceptance(before: DataFrame, after: DataFrame) -> DataFrame:
    """Q-3 to Q-6: one row of counts and verdicts. A: no core row without text. B: no variation without text that can
    be resolved. C, D: at least four fifths fewer functional statements and verification methods without text. Unlinked
    variations are counted and change no verdict."""
    kind = F.col("unit_type")
    unresolved = blank("raw_text") | F.contains("notes_quality", F.lit("MISSING_TEXT_UNRESOLVED"))
    variation = kind == "STATE_VARIATION"
    metrics = {
        "core": kind.isin(CORE_TYPES) & blank("text"),
        "variations": variation & blank("text") & ~unresolved,
        "unresolved": variation & blank("text") & unresolved,
        "unlinked": variation & blank("base_unit_label") & ~F.contains("notes_quality", F.lit("UNLINKED_VARIATION")),
        "functional": (kind == "FUNCTIONAL_STATEMENT") & blank("text"),
        "verification": (kind == "VERIFICATION_METHOD") & blank("text"),
    }
    count = lambda df, s: df.agg(*[_n(c).alias(f"{m}_{s}") for m, c in metrics.items()])
    both = count(before, "before").crossJoin(count(after, "after"))  # one row each
    better = lambda m: F.when(F.col(f"{m}_before") > 0, F.round(100 * (F.col(f"{m}_before") - F.col(f"{m}_after")) / F.col(f"{m}_before"), 1)).otherwise(0.0)
    verdicts = {"a_passed": F.col("core_after") == 0, "b_passed": F.col("variations_after") == 0, "c_passed": F.col("functional_after") <= 0.2 * F.col("functional_before"), "d_passed": F.col("verification_after") <= 0.2 * F.col("verification_before")}
    out = both.withColumns({"functional_improvement": better("functional"), "verification_improvement": better("verification"), **verdicts})
    return out.withColumn("passed", reduce(lambda a, b: a & b, [F.col(v) for v in verdicts]))


def backfill_tables(units: DataFrame) -> DataFrame:
    """Q-7: rows with a bad table_id lose it and its label; rows with a good one get missing codes from it."""
    some = ~blank("table_id")
    good = some & U.is_table_id(F.col("table_id"))
    fill = lambda c, f: F.when(good & blank(c), f(F.col("table_id"))).otherwise(F.col(c))
    section, part = fill("section_code", U.section_code), fill("part_code", U.part_code)
    updated = good & ((section != F.col("section_code")) | (part != F.col("part_code")))
    cleared = some & ~good
    clear = lambda c: F.when(cleared, "").otherwise(F.col(c))
    return units.select(*[c for c in units.columns if c not in ("section_code", "part_code", "table_id", "table_label")], section.alias("section_code"), part.alias("part_code"), clear("table_id").alias("table_id"), clear("table_label").alias("table_label"), updated.alias("updated"), cleared.alias("cleared"))


def backfill_summary(filled: DataFrame) -> DataFrame:
    """S-11: counts of a backfill."""
    return filled.agg(F.count(F.lit(1)).alias("total_rows"), _n(F.col("updated")).alias("updated_rows"), _n(F.col("cleared")).alias("cleared_rows"), _n(~F.col("updated") & ~F.col("cleared")).alias("skipped_rows"))


def duplicate_anchors(units: DataFrame) -> DataFrame:
    """Q-9."""
    return units.where("anchor_id <> ''").groupBy("anchor_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def invalid_enums(units: DataFrame) -> DataFrame:
    """Q-10: values outside the allowed lists, of the columns that ``units`` has, from one pass."""
    bad = [F.when(~F.col(c).isin(ok), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"))) for c, ok in ENUMS.items() if c in units.columns]
    return units.select(F.explode(F.array_compact(F.array(*bad))).alias("x")).groupBy("x.column_name", "x.value").agg(F.count(F.lit(1)).alias("n"))


def quality_flags() -> Column:
    """Q-11: MISSING_TEXT, MISSING_TITLE, CONTEXT_INFERRED, STATE_VARIATION_EMBEDDED, TABLE_BLOB_ONLY, as a pipe list."""
    kind = F.col("unit_type")
    rules = {
        "MISSING_TEXT": blank("text"),
        "MISSING_TITLE": blank("title"),
        "CONTEXT_INFERRED": U.label_type(F.col("unit_label"), "") != kind,
        "STATE_VARIATION_EMBEDDED": (kind != "STATE_VARIATION") & F.col("text").rlike(V.MARKER),
        "TABLE_BLOB_ONLY": F.contains("text", F.lit("[TABLE]")) & ~F.contains("text", F.lit("| --- |")),
    }
    return F.array_join(F.array_compact(F.array(*[F.when(c, f) for f, c in rules.items()])), "|")


def gates(units: DataFrame) -> DataFrame:
    """Q-12, A-15: seven gates: rows that break each, and whether none does. Needs rag_text, base_unit_label and refs."""
    kind = F.col("unit_type")
    rules = {
        "empty_rag_text": blank("rag_text"),
        "variation_without_instruction": (kind == "STATE_VARIATION") & ~F.col("text").rlike(V.INSTRUCTION),
        "bad_heading": F.length("title") > 150,
        "core_without_text": kind.isin(CORE_TYPES) & blank("text"),
        "self_reference": F.array_contains("internal_refs", F.col("unit_label")),
        "variation_without_base": (kind == "STATE_VARIATION") & blank("base_unit_label"),
        "table_without_grid": F.contains("text", F.lit("[TABLE]")) & ~F.contains("text", F.lit("|")),
    }
    counted = units.agg(*[_n(c).alias(g) for g, c in rules.items()])
    rows = counted.selectExpr(f"stack({len(rules)}, {', '.join(f"'{g}', {g}" for g in rules)}) as (gate, failures)")
    return rows.withColumn("passed", F.col("failures") == 0)
