"""From content to published units: segmentation, text, tables, classification, and the wide projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausemill.functions import units as U
from clausemill.functions import variations as V
from clausemill.functions.text import CELL_LIMIT, is_truncated, strip, truncate_hard
from clausemill.operators.lookups import with_discipline
from clausemill.operators.scans import CHUNK, running
from clausemill.operators.tables import early_refs, table_texts
from clausemill.sources.files import written

#: The published columns, in order; the last three are in the specification only.
PUBLISHED = [
    "doc_id", "volume", "state_variation", "version_date", "source_file", "path", "anchor_id", "parent_anchor_id",
    "order_in_parent", "para_start", "para_end", "unit_label", "unit_type", "compliance_weight", "title", "text",
    "text_html", "defined_term", "contains_shall", "contains_must", "external_refs", "internal_refs",
    "satisfies_pr_ids", "related_unit_ids", "asset_type", "asset_id", "asset_caption", "asset_alt_text", "page_start",
    "page_end", "bbox_json", "extract_confidence", "warnings", "ncc_pathway", "normative_status", "conditionality",
    "heading_context", "raw_title", "raw_text", "applies_state", "variation_action", "affected_unit_label",
    "affected_subparts", "affects_anchor_id", "table_grid_json", "table_key_values", "base_unit_label",
    "affected_subclause", "conditions_text", "exceptions_text", "requirements_list", "standards_referenced",
    "notes_quality", "discipline", "table_purpose", "table_id", "table_label", "applies_to_volume", "applies_to_class",
    "volume_hierarchy", "dataset_coverage", "scope_conditions", "formula_json", "constant_value", "constant_name",
    "pathway_alternative_to", "verification_method_for", "section_code", "part_code", "indexable", "rag_text", "notes",
    "exceptions",
]
_WORK = ["volume", "row_type", "heading_level", "heading_text", "unit_type", "clause_ref", "text", "source_location"]


def content_segments(content: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """U-3 to U-5: paragraphs (doc_id, idx, tag, text) with their reference and unit; every reference opens a unit, so
    unit 0 is what stands before the first (U-10, O-4)."""
    rows = content.withColumn("text", strip(F.col("text"))).where("text <> ''").withColumn("ref", U.clause_ref(F.col("text")))
    return running(rows, "idx", sums={"seg": (F.col("ref") != "").cast("int")}, chunk=chunk)


def table_placement(content: DataFrame, cells: DataFrame, placement: str = "appended") -> DataFrame:
    """U-9: (doc_id, table_idx, seg): the unit that a table's text belongs to, none if the first nine cells hold another
    reference. "appended" puts all tables after all paragraphs, so they fall to the last unit; "inline" takes each
    table's own place, column ``at`` of cells."""
    return _placed(content_segments(content), cells, early_refs(cells), placement).select("doc_id", "table_idx", "seg")


def _placed(segs: DataFrame, cells: DataFrame, tables: DataFrame, placement: str) -> DataFrame:
    """``tables`` (doc_id, table_idx, early) that belong to a unit of ``segs``, with its seg."""
    if placement == "appended":
        # Every reference opens a unit, so the last one is the last unit's.
        last = segs.groupBy("doc_id").agg(F.max("seg").alias("seg"), F.max_by("ref", F.when(F.col("ref") != "", F.col("seg"))).alias("unit_ref"))
        placed = tables.join(last, "doc_id")
    else:
        marks = segs.select("doc_id", F.col("idx").alias("at"), "seg", F.lit(None).cast("long").alias("table_idx"))
        own = cells.select("doc_id", "at", F.lit(None).cast("long").alias("seg"), F.col("table_idx").cast("long").alias("table_idx")).distinct()
        order = Window.partitionBy("doc_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        at = marks.unionByName(own).withColumn("seg", F.coalesce(F.last("seg", ignorenulls=True).over(order), F.lit(0))).where("table_idx is not null").select("doc_id", "table_idx", "seg")
        heads = segs.where("ref <> ''").select("doc_id", "seg", F.col("ref").alias("unit_ref"))
        placed = at.join(heads, ["doc_id", "seg"], "left").join(tables, ["doc_id", "table_idx"])
    return placed.where(F.col("unit_ref").isNull() | ~F.exists("early", lambda r: r != F.col("unit_ref")))


def paragraph_units(content: DataFrame, volume: Column, cells: DataFrame | None = None, placement: str = "appended", tables: DataFrame | None = None) -> DataFrame:
    """U-5 to U-10, U-12, U-13, P-8: a work row for each unit, its paragraphs and tables joined by blank lines. Pieces that
    begin behind the limit of a text are left out before a unit is put together. ``tables`` is what ``table_texts`` gives,
    where it is at hand. Paragraphs are written with their unit; what is read of them for the bounds of units are numbers."""
    segs = written(content_segments(content))
    own = segs.groupBy("doc_id", "seg").agg(F.min("idx").cast("long").alias("first"), F.max("idx").cast("long").alias("own_last"))
    after = F.lead("first").over(Window.partitionBy("doc_id").orderBy("seg"))
    bounds = own.select("doc_id", "seg", "first", F.coalesce(after - 1, "own_last").alias("last"))
    items = segs.select("doc_id", "seg", F.lit(0).alias("kind"), F.col("idx").cast("long").alias("at"), "text", "tag", "ref")
    if cells is not None:
        placed = _placed(segs, cells, table_texts(cells) if tables is None else tables, placement)
        if placement != "appended":
            placed = placed.join(segs.select("doc_id").distinct(), "doc_id", "left_semi")
        body = F.concat(F.lit("\n\n[TABLE]\n"), "rendered", F.lit("\n[/TABLE]"))
        items = items.unionByName(placed.select("doc_id", "seg", F.lit(1).alias("kind"), F.col("table_idx").cast("long").alias("at"), body.alias("text"), F.lit("table").alias("tag"), F.lit("").alias("ref")))
    behind = Window.partitionBy("doc_id", "seg").orderBy("kind", "at").rowsBetween(Window.unboundedPreceding, -1)
    items = items.withColumn("begins", F.coalesce(F.sum(F.length("text") + 2).over(behind), F.lit(0)))
    # What begins two characters behind the limit follows a text that just fits, and makes it one that does not.
    items = items.where(F.col("begins") <= CELL_LIMIT + 2)
    grouped = items.groupBy("doc_id", "seg").agg(F.sort_array(F.collect_list(F.struct("kind", "at", "text", "tag", "ref"))).alias("p"))
    head = F.element_at("p", 1)
    text = F.array_join(F.transform("p", lambda x: x["text"]), "\n\n")
    rows = grouped.join(bounds, ["doc_id", "seg"], "left").select("doc_id", "seg", "first", "last", head["ref"].alias("clause_ref"), head["tag"].alias("tag"), head["text"].alias("head"), text.alias("whole"))
    is_unit = F.col("seg") > 0
    cut = F.when(is_truncated(F.col("whole")), "_truncated").otherwise("")
    where = F.concat(F.when(is_unit, "para_").otherwise("content_"), F.col("first").cast("string"), F.lit("_to_"), F.col("last").cast("string"), cut)
    return rows.select(
        "doc_id",
        F.lit(0).alias("pass_no"),
        F.col("seg").cast("long").alias("place"),
        volume.alias("volume"),
        F.lit("paragraph").alias("row_type"),
        F.when(is_unit, U.heading_level(F.col("tag"))).otherwise("").alias("heading_level"),
        F.when(is_unit, U.heading_text(F.col("head"), F.col("clause_ref"))).otherwise("").alias("heading_text"),
        U.unit_type(truncate_hard(F.col("whole"))).alias("unit_type"),
        F.when(is_unit, F.col("clause_ref")).otherwise("").alias("clause_ref"),
        truncate_hard(F.col("whole")).alias("text"),
        where.alias("source_location"),
    )


def table_units(cells: DataFrame, volume: Column, tables: DataFrame | None = None) -> DataFrame:
    """U-11: a work row for each table; its reference is its first cell's that has one, else its number."""
    rows = table_texts(cells) if tables is None else tables
    ref = F.concat(F.lit("table "), F.coalesce("ref", (F.col("table_idx") + 1).cast("string")))
    where = F.concat(F.lit("table_"), F.col("table_idx").cast("string"), F.when(F.col("ref").isNotNull(), F.concat(F.lit("_"), "ref")).otherwise(""), F.when(is_truncated(F.col("rendered")), "_truncated").otherwise(""))
    return rows.select("doc_id", F.lit(1).alias("pass_no"), F.col("table_idx").cast("long").alias("place"), volume.alias("volume"), F.lit("table").alias("row_type"), F.lit("").alias("heading_level"), F.lit("").alias("heading_text"), U.unit_type(truncate_hard(F.col("rendered"))).alias("unit_type"), ref.alias("clause_ref"), truncate_hard(F.col("rendered")).alias("text"), where.alias("source_location"))


def work_rows(content: DataFrame, cells: DataFrame, volume: Column, placement: str = "appended") -> DataFrame:
    """O-2: the units of paragraphs and of tables, whose text is made once for both."""
    tables = written(table_texts(cells))
    return paragraph_units(content, volume, cells, placement, tables).unionByName(table_units(cells, volume, tables))


def length_guard(rows: DataFrame, *columns: str) -> DataFrame:
    """U-28: columns cut to the cell limit again, and how many were."""
    over = sum((is_truncated(F.col(c)).cast("int") for c in columns), F.lit(0))
    return rows.withColumn("n_truncated", over).withColumns({c: truncate_hard(F.col(c)) for c in columns})


def row_summary(rows: DataFrame) -> DataFrame:
    """U-27, S-12."""
    return rows.agg(F.count_if(F.col("row_type") == "paragraph").alias("paragraphs"), F.count_if(F.col("row_type") == "table").alias("tables"), F.count(F.lit(1)).alias("total_rows"), F.count_if(F.length("text") >= CELL_LIMIT).alias("at_limit"))


def table_labels(rows: DataFrame) -> DataFrame:
    """U-24, U-25, W-5: table_id and table_label of ordered rows (doc_id, ord, clause_ref, heading_text): a table's own
    heading, else the first seen so far for its id."""
    label = U.bare_ref(F.col("clause_ref"))
    titled = F.lower(strip(F.col("heading_text"))).rlike(r"^table\s")
    is_table = (F.lower("clause_ref").rlike(r"^table ") | titled) & U.is_table_id(label)
    own = F.when(is_table & titled, strip(F.regexp_extract(strip(F.col("heading_text")), r"(?i)^(Table\s+[^:]+(?::\s*[^\n]+)?)", 1)))
    carry = Window.partitionBy("doc_id", "table_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    ready = rows.withColumn("table_id", F.when(is_table, label).otherwise("")).withColumn("own", own)
    seen = F.when(F.col("table_id") == "", "").otherwise(F.coalesce("own", F.first("own", ignorenulls=True).over(carry), F.lit("")))
    return ready.withColumn("table_label", seen).drop("own")


def publish(rows: DataFrame, mapping: DataFrame | None = None, source_file: str = "") -> DataFrame:
    """U-14 to U-26, V-10 to V-27: work rows (doc_id, pass_no, place, _WORK) as the 73 published columns, in order. Fields
    without a source are ''; doc_id is a string."""
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy("pass_no", "place")) - 1
    rows = table_labels(rows.withColumn("ord", order)).withColumn("unit_label", U.bare_ref(F.col("clause_ref")))
    rows = with_discipline(rows, mapping) if mapping is not None else rows.withColumn("discipline", F.lit(""))
    text, kind, label, ref = (F.col(c) for c in ("text", "unit_type", "unit_label", "clause_ref"))
    start, end = U.paragraph_range(F.col("source_location"))
    fallback = U.with_fallback(F.col("table_id"), label)
    part = U.with_fallback(U.part_code(ref), U.part_code(fallback))
    made = {
        "doc_id": F.col("doc_id").cast("string"),
        "volume": F.col("volume"),
        "source_file": F.lit(source_file),
        "path": F.col("volume"),
        "anchor_id": U.anchor_id(ref, F.col("volume")),
        "order_in_parent": F.col("ord"),
        "para_start": start,
        "para_end": end,
        "unit_label": label,
        "unit_type": kind,
        "compliance_weight": U.compliance_weight(kind),
        "title": F.col("heading_text"),
        "text": text,
        "text_html": text,
        "defined_term": F.when(kind == "DEFINITION", V.defined_term(text)).otherwise(""),
        "contains_shall": U.contains_word(text, "shall"),
        "contains_must": U.contains_word(text, "must"),
        "external_refs": F.to_json(V.external_refs(text)),
        "internal_refs": F.to_json(V.internal_refs(text, label)),
        "ncc_pathway": U.pathway(kind),
        "normative_status": U.normative_status(kind),
        "conditionality": V.conditionality(U.pathway(kind)),
        "heading_context": F.col("heading_level"),
        "raw_title": F.col("heading_text"),
        "raw_text": text,
        "base_unit_label": label,
        "conditions_text": V.conditions(text),
        "exceptions_text": V.exceptions(text),
        "requirements_list": V.requirement_sentences(text),
        "standards_referenced": F.array_join(V.external_refs(text), "|"),
        "discipline": F.col("discipline"),
        "table_id": F.col("table_id"),
        "table_label": F.col("table_label"),
        "applies_to_volume": V.applies_to_volume(F.col("volume")),
        "applies_to_class": V.building_classes(text),
        "volume_hierarchy": V.hierarchy_path(F.col("volume"), part, label),
        "scope_conditions": V.scope_conditions(text),
        "formula_json": V.formula_json(text),
        "constant_value": V.constant_value(text),
        "constant_name": F.when(V.constant_value(text) != "", V.constant_name(text)).otherwise(""),
        "section_code": U.with_fallback(U.section_code(ref), U.section_code(fallback)),
        "part_code": part,
        "indexable": F.lit(True),
        "rag_text": V.rag_text(kind, label, F.col("heading_text"), text),
    }
    return rows.select(*[made.get(c, F.lit("")).alias(c) for c in PUBLISHED])
