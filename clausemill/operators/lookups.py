"""Dimension lookups, the jurisdiction overlay, and reference graphs over units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions.units import bare_ref, clause_part_code

from .matching import DICTIONARY_BYTES, dictionary_join

def discipline_map(topic: DataFrame, topic_part: DataFrame) -> DataFrame:
    """J-3, O-3: (volume, code, disciplines): of each volume and code the disciplines in first-seen order, each once.
    A topic without part codes stands under its section code."""
    rows = topic.join(topic_part, "topic_id", "left").select("volume", F.coalesce("part_code", "section_code").alias("code"), "topic_id", "seq", "discipline").where("discipline is not null")
    listed = rows.groupBy("volume", "code").agg(F.array_sort(F.collect_list(F.struct("topic_id", "seq", "discipline"))).alias("d"))
    return listed.select("volume", "code", F.array_distinct(F.transform("d", lambda x: x["discipline"])).alias("disciplines"))


def with_discipline(units: DataFrame, mapping: DataFrame, ref: str = "unit_label") -> DataFrame:
    """J-1: the discipline of a unit: by part code, else section letter, else section letter and number."""
    clean = bare_ref(F.col(ref))
    steps = {"by_part": clause_part_code(F.col(ref)), "by_letter": F.regexp_extract(clean, r"^([A-Z])", 1), "by_section": F.regexp_extract(clean, r"^([A-Z]\d+)", 1)}
    out = units
    for name, key in steps.items():
        dim = mapping.select("volume", F.col("code").alias(f"{name}_code"), F.array_join("disciplines", ", ").alias(name))
        out = out.withColumn(f"{name}_code", key).join(dim, ["volume", f"{name}_code"], "left").drop(f"{name}_code")
    return out.withColumn("discipline", F.coalesce(*steps, F.lit(""))).drop(*steps)


def codes_of_discipline(mapping: DataFrame, volume: str, discipline: str) -> DataFrame:
    """J-4."""
    return mapping.where((F.col("volume") == volume) & F.array_contains("disciplines", discipline)).select("volume", "code")


def discipline_coverage(mapping: DataFrame) -> DataFrame:
    """A-16: codes and different disciplines of each volume."""
    return mapping.select("volume", "code", F.explode("disciplines").alias("d")).groupBy("volume").agg(F.count_distinct("code").alias("codes"), F.count_distinct("d").alias("disciplines"))


def variation_anchors(variations: DataFrame, units: DataFrame) -> DataFrame:
    """J-9: variations (volume, ord, base_unit_label) with the least anchor of the unit of that label, null if none."""
    base = units.where("unit_label <> ''").groupBy("volume", F.col("unit_label").alias("base_unit_label")).agg(F.min("anchor_id").alias("affects_anchor_id"))
    return variations.join(base, ["volume", "base_unit_label"], "left")


def overlay(units: DataFrame, state: str) -> DataFrame:
    """J-10: national units and those of one state, side by side."""
    return units.where(F.col("applies_state").isin("", state))


def effective_view(units: DataFrame, state: str) -> DataFrame:
    """J-10: the overlay without national units whose label a DELETE or REPLACE of the state names."""
    both = overlay(units, state)
    gone = both.where((F.col("applies_state") == state) & F.col("variation_action").isin("DELETE", "REPLACE")).select("volume", F.col("affected_unit_label").alias("unit_label")).distinct()
    return both.where("applies_state = ''").join(gone, ["volume", "unit_label"], "left_anti").unionByName(both.where(F.col("applies_state") == state))


def reference_edges(units: DataFrame, refs: Column) -> DataFrame:
    """J-11: (volume, ord, unit_label, ref, resolved, is_self) of every label that a unit names."""
    edges = units.select("volume", "ord", "unit_label", F.explode(refs).alias("ref"))
    known = units.select("volume", F.col("unit_label").alias("ref")).distinct().withColumn("known", F.lit(True))
    return edges.join(known, ["volume", "ref"], "left").select("volume", "ord", "unit_label", "ref", F.coalesce("known", F.lit(False)).alias("resolved"), (F.col("ref") == F.col("unit_label")).alias("is_self"))


def missing_parents(units: DataFrame, parent: Column) -> DataFrame:
    """J-12: units whose parent anchor does not exist."""
    named = units.select("volume", "ord", "unit_label", parent.alias("parent_anchor_id")).where("parent_anchor_id <> ''")
    return named.join(units.select(F.col("anchor_id").alias("parent_anchor_id")), "parent_anchor_id", "left_anti")


def compliance_chain(units: DataFrame) -> DataFrame:
    """J-13: per volume and part, how many units of each step of the chain there are, which performance requirements
    its provisions and methods satisfy, and whether the chain has a gap."""
    pr = F.collect_set(F.when(F.col("unit_type") == "PERFORMANCE_REQUIREMENT", F.col("unit_label")))
    n = lambda *kinds: F.count_if(F.col("unit_type").isin(*kinds))
    rows = units.where("part_code <> ''").groupBy("volume", "part_code").agg(n("OBJECTIVE").alias("objectives"), n("FUNCTIONAL_STATEMENT").alias("functionals"), n("PERFORMANCE_REQUIREMENT").alias("requirements"), n("DTS_PROVISION", "VERIFICATION_METHOD").alias("solutions"), F.array_join(F.array_sort(pr), "|").alias("satisfies_pr_ids"))
    return rows.withColumn("complete", (F.col("objectives") > 0) & (F.col("functionals") > 0) & (F.col("requirements") > 0) & (F.col("solutions") > 0))


def keyword_hits(questions: DataFrame, keywords: DataFrame, limit_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """J-14: (qid, question, topic_id, keyword, kind) for each keyword inside a question, whatever the case. An empty keyword
    is in none. See ``matching.dictionary_join`` for the plan at each size."""
    found = dictionary_join(questions, "question", "qid", keywords.select("topic_id", "keyword", "kind"), "keyword", limit_bytes)
    return found.select("qid", "question", "topic_id", "keyword", "kind")


def parents_by_level(rows: DataFrame, level: str = "level", deepest: int = 5) -> DataFrame:
    """V-26: of ordered rows (doc_id, ord, level) the parent, the nearest row before of a smaller level, and the
    position under it, from 0."""
    before = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    last = [F.last(F.when(F.col(level) == k, F.col("ord")), ignorenulls=True).over(before) for k in range(deepest)]
    parent = F.greatest(*[F.when(F.col(level) > k, last[k]) for k in range(deepest)], F.lit(None).cast("long"))
    placed = rows.withColumn("parent_ord", parent)
    return placed.withColumn("order_in_parent", F.row_number().over(Window.partitionBy("doc_id", "parent_ord").orderBy("ord")) - 1)
