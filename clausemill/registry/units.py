"""Units: scalars, variations, assembly from pages and paragraphs, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.functions import units as U
from clausemill.functions import variations as V
from clausemill.operators import blocks as B
from clausemill.operators import lookups as L
from clausemill.operators import tables as T
from clausemill.operators.scans import running
from clausemill.plans import units as P
from clausemill.sources import fixtures as X

from .sql import bare_ref, clause_ref, discipline_map, last_part, part, section, strip, unit_type

# ---- units with the columns that other operators read

_WARN = "case when ord % 4 = 0 then 'STATE_VARIATION_EMBEDDED' else '' end warnings"
_EXTRA = f"""{_WARN}, case when ord % 13 = 0 then 'MISSING_TEXT|CHECKED' else '' end notes_quality,
  case when ord % 6 = 0 then concat('table ', unit_label) when ord % 10 = 9 then cast(ord as string) else unit_label end clause_ref,
  case when ord % 6 = 0 then unit_label when ord % 10 = 9 then '14' else '' end table_id,
  case when ord % 12 = 0 then concat('Table ', unit_label, ': Sizes') else '' end table_label,
  case when ord % 3 = 0 then '' else unit_label end base_unit_label, concat(text, case when ord % 5 = 1 then ' NSW H4D5(2) applies' else '' end,
    case when ord % 17 = 5 then ' [TABLE] blob' when ord % 17 = 6 then ' [TABLE] | a | b |' when ord % 17 = 7 then ' [TABLE] | a | | --- |' else '' end) marked"""


def derived(s, d) -> DataFrame:
    """Units with codes, anchor, status, pathway, weight, and the columns of quality jobs."""
    rows = X.units(s, d).selectExpr("*", *X.split_columns(_EXTRA))
    kind = F.col("unit_type")
    return rows.withColumns(
        {
            "section_code": U.section_code(F.col("clause_ref")),
            "part_code": U.part_code(F.col("clause_ref")),
            "anchor_id": U.anchor_id(F.col("clause_ref"), F.col("volume")),
            "normative_status": U.normative_status(kind),
            "ncc_pathway": U.pathway(kind),
            "compliance_weight": U.compliance_weight(kind),
            "applies_to_volume": V.applies_to_volume(F.col("volume")),
            "path": F.col("volume"),
            "indexable": V.is_indexable(kind),
            "variation_action": F.when(kind == "STATE_VARIATION", V.variation_action(F.col("text"))).otherwise(""),
            "affected_unit_label": F.when(kind == "STATE_VARIATION", F.regexp_extract("text", r"after ([A-Z]\d+[A-Z]\d+)", 1)).otherwise(""),
        }
    )


_WEIGHT = "case when unit_type = 'PERFORMANCE_REQUIREMENT' then 'MANDATORY' when unit_type in ('DTS_PROVISION', 'VERIFICATION_METHOD') then 'OPTIONAL_PATHWAY' else 'NON_MANDATORY' end"
_ACTION = """case when regexp_matches(text, '(?i)\\b(does not apply|not applicable|left blank)\\b') then 'NOT_APPLICABLE' when regexp_matches(text, '(?i)\\b(delete|omit)\\b') then 'DELETE'
    when regexp_matches(text, '(?i)\\b(replace|substitute)\\b') then 'REPLACE' when regexp_matches(text, '(?i)\\binsert\\b') then 'INSERT' else 'AMEND_PART' end"""
DERIVED_SQL = f"""(select *, {section('clause_ref')} section_code, {part('clause_ref')} part_code,
    case when clause_ref = '' then '' else upper(volume) || '::' || {bare_ref('clause_ref')} end anchor_id,
    case when unit_type in ('PERFORMANCE_REQUIREMENT', 'DTS_PROVISION', 'VERIFICATION_METHOD') then 'NORMATIVE' else 'INFORMATIVE' end normative_status,
    case unit_type when 'PERFORMANCE_REQUIREMENT' then 'PERFORMANCE' when 'DTS_PROVISION' then 'DTS' when 'VERIFICATION_METHOD' then 'VERIFICATION' else 'OBJECTIVE' end ncc_pathway,
    {_WEIGHT} compliance_weight, replace(volume, 'Vol', 'V') applies_to_volume, volume path, unit_type not in ('VOLUME', 'SECTION', 'PART', 'SUBPART') indexable,
    case when unit_type = 'STATE_VARIATION' then {_ACTION} else '' end variation_action,
    case when unit_type = 'STATE_VARIATION' then regexp_extract(text, 'after ([A-Z]\\d+[A-Z]\\d+)', 1) else '' end affected_unit_label
    from (select *, {_EXTRA} from {X.UNITS_SQL}))"""

# ---- paragraphs that hold references, variations and phrases

_STATE = "concat(substr('NSWVICQLDTAS', cast(1 + 3 * (para_idx % 4) as int), 3), ' ', substr('ABCDEFGH', cast(1 + doc_id % 8 as int), 1), cast(1 + para_idx % 9 as string), 'P', cast(1 + doc_id % 9 as string))"
_PHRASES = f"""doc_id, para_idx, case para_idx % 9
    when 0 then concat({_STATE}, '(', cast(1 + para_idx % 3 as string), ')  ', text)
    when 1 then concat('A building must comply with AS ', cast(1000 + para_idx as string), ' and AS/NZS 3500. If the ramp is steep, it shall be fixed. See H4D5 and H4D5 and E3P1.')
    when 2 then concat('The clear height of the door must be ', cast(para_idx * 10 as string), ' mm except in a Class 2 or Class 10 building.')
    when 3 then concat('Area means the product A = L × W. ', text)
    when 4 then concat('SECTION ', substr('ABCDEFGH', cast(1 + doc_id % 8 as int), 1), ' Fire resistance')
    when 5 then 'Objectives and aims'
    when 6 then concat('PART ', substr('ABCDEFGH', cast(1 + doc_id % 8 as int), 1), '1 General plumbing')
    when 7 then concat('Delete clause ', {_STATE}, '. Where it does not apply, refer to E3P1 unless stated')
    else text end text"""
PHRASES_SQL = f"(select {_PHRASES} from {X.PARAGRAPHS_SQL})"


def phrases(s, d) -> DataFrame:
    return X.clause_paragraphs(s, d).selectExpr(*X.split_columns(_PHRASES))


def _text(**columns):
    """A query over the phrases with a column from each function of the text."""
    return lambda s, d: phrases(s, d).select("doc_id", "para_idx", *[f(F.col("text")).alias(c) for c, f in columns.items()])


def _sql(**columns):
    return f"select doc_id, para_idx, {', '.join(f'{e} {c}' for c, e in columns.items())} from {PHRASES_SQL}"


_RX = r"(?i)^(SA|NSW|VIC|QLD|WA|TAS|ACT|NT)\s+([A-Z]{1,2}\d+\s*[A-Z]?\d*(?:\(\d+\))?)(\b|to\b|\s|$)"
_HEAD = r"(?i)^(?:SA|NSW|VIC|QLD|WA|TAS|ACT|NT)\s+[A-Z]{1,2}\d+\s*[A-Z]?\d*(?:\(\d+\))?"
_BODY = f"case when regexp_matches(text, '{_HEAD}') then {strip(f"regexp_replace(regexp_replace(text, '{_HEAD}', ''), '^\\s*[–—:.-]?\\s*', '')")} else '' end"
_LABEL = f"regexp_replace(regexp_extract(text, '{_RX}', 2), '\\s+', '', 'g')"
_CLASSES = r"coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(text, '\bClass\s*(10|[1-9])', 1))), '|'), '')"
_SCOPE = r"case when regexp_matches(text, '(?i)\b(plumbing|drainage)\b') then 'Vol3' when regexp_matches(text, '\bClass\s*(10|1)\b') then 'Vol2' when regexp_matches(text, '\bClass\s*[2-9]\b') then 'Vol1' else '' end"
_FORMULA = r"regexp_extract(text, '\b([A-Z][A-Za-z]?)\s*=\s*([A-Z0-9][A-Z0-9 ×*+/().-]*)', 0)"


def _once(lst: str) -> str:
    """Distinct items in first-seen order."""
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


def _chain_rows(s, d):
    """Ordered rows with levels for parents: structural headings of the phrases."""
    kind = V.structural_type(F.col("text"))
    level = F.when(kind == "VOLUME", 0).when(kind == "SECTION", 1).when(kind == "PART", 2).when(kind == "SUBPART", 3).otherwise(4)
    return phrases(s, d).select("doc_id", F.col("para_idx").cast("long").alias("ord"), level.alias("level"))


def _contexts(s, d):
    part_heading = F.when(V.structural_type(F.col("text")) == "PART", F.regexp_extract("text", r"^P(?:ART|art)\s+(\S+)", 1))
    # The text itself is not carried along.
    own = phrases(s, d).select("doc_id", "para_idx", V.context_type(F.col("text")).alias("own"), part_heading.alias("part"), U.label_type(U.clause_ref(F.col("text")), "").alias("label"))
    rows = running(own, "para_idx", lasts={"context": F.col("own"), "part_heading": F.col("part")})
    inferred = F.col("label") == ""
    kind = F.when(inferred, F.coalesce("context", F.lit("OTHER"))).otherwise(F.col("label"))
    return rows.select("doc_id", "para_idx", kind.alias("unit_type"), F.coalesce("part_heading", F.lit("")).alias("part_heading"), inferred.alias("context_inferred"))


def _content(s, d):
    """Phrases as content of documents, with tags."""
    return phrases(s, d).select("doc_id", F.col("para_idx").alias("idx"), F.when(F.col("para_idx") % 9 == 4, "h2").otherwise("p").alias("tag"), "text")


def _volume():
    return U.volume_label(F.concat(F.lit("vol"), (1 + F.pmod("doc_id", F.lit(3))).cast("string")))


def _work(s, d):
    return P.work_rows(_content(s, d), X.cells(s, d), _volume())


def _page_units(s, d):
    """Pages end to end: elements, cells, units, published columns."""
    pages = X.page_html(s, d)
    content = T.html_elements(pages).where("tag <> 'table'").select("doc_id", F.col("dom_idx").alias("idx"), "tag", "text")
    cells = T.html_cells(pages)
    rows = P.work_rows(content, cells, _volume())
    dims = X.dims(s, d)
    return P.publish(rows, L.discipline_map(dims["topic"], dims["topic_part"]), "pages")


def _nested_units(s, d):
    """Pages end to end with blocks inside blocks: every block outside tables is content, ancestors included."""
    pages = X.nested_pages(s, d)
    content = B.page_blocks(B.html_blocks(pages)).select("doc_id", F.col("start").alias("idx"), "tag", "text")
    return P.publish(P.work_rows(content, T.html_cells(pages), _volume()), None, "pages")


def _elements(s, d):
    """Elements from paragraphs: a table after every seventh, a heading after every ninth."""
    p = X.clause_paragraphs(s, d)
    kind = F.when(F.col("para_idx") % 7 == 6, "table").when(F.col("para_idx") % 9 == 8, "h3").otherwise("p")
    return p.select("doc_id", (F.col("para_idx") * 9 + F.pmod("doc_id", F.lit(4)).cast("int")).alias("dom_idx"), kind.alias("tag"), "text")


def _cell_captions(s, d):
    keys = X.cells(s, d).select("doc_id", "table_idx").distinct()
    return keys.select("doc_id", "table_idx", F.concat(F.lit("Table "), F.col("table_idx").cast("string")).alias("table_id"), F.lit("Sizes").alias("title"), F.lit("").alias("notes"), F.lit(-1).alias("paragraph_index"))


QUERIES = {
    "u02_u20_codes": lambda s, d: derived(s, d).select("volume", "ord", "clause_ref", "section_code", "part_code", "anchor_id", "normative_status", "ncc_pathway", "compliance_weight", "applies_to_volume", "indexable", U.volume_label(F.lower("volume")).alias("volume_label"), U.label_type(F.col("unit_label")).alias("label_type"), U.is_table_id(F.col("table_id")).alias("good_table_id")),
    "u03_clause_refs": _text(ref=U.clause_ref),
    "u07_heading_text": _text(heading=lambda t: U.heading_text(t, U.clause_ref(t)), heading_at_word=lambda t: U.heading_text(t, U.clause_ref(t), at_word=True)),
    "u13_unit_type": _text(unit_type=U.unit_type),
    "u17_paragraph_range": lambda s, d: derived(s, d).select("volume", "ord", U.paragraph_range(F.expr("case when ord % 3 = 0 then 'table_4' else concat('para_', cast(ord as string), '_to_', cast(ord + 5 as string)) end"))[0].alias("first"), U.paragraph_range(F.expr("case when ord % 3 = 0 then 'table_4' else concat('para_', cast(ord as string), '_to_', cast(ord + 5 as string)) end"))[1].alias("last")),
    "u22_modality": _text(contains_shall=lambda t: U.contains_word(t, "shall"), contains_must=lambda t: U.contains_word(t, "must")),
    "v01_variation_headings": _text(state=V.variation_state, label=V.variation_label, body=V.variation_body),
    "v02_base_labels": _text(base=lambda t: V.base_label(V.variation_label(t)), subclause=lambda t: V.subclause(V.variation_label(t))),
    "v03_continuations": lambda s, d: V.attach_continuations(phrases(s, d)),
    "v04_actions": _text(action=V.variation_action),
    "v07_markers": lambda s, d: derived(s, d).select("volume", "ord", F.explode(V.markers(F.col("marked"))).alias("marker")),
    "v08_unextracted": lambda s, d: phrases(s, d).where(V.is_unextracted_instruction(F.col("text"))).orderBy("doc_id", "para_idx").limit(15).select("doc_id", "para_idx", F.substring("text", 1, 220).alias("preview")),
    "v09_needle": lambda s, d: derived(s, d).where(F.contains("text", F.lit("AS 1001")) | F.contains("raw_text", F.lit("AS 1001"))).orderBy("volume", "ord").limit(10).select("volume", "ord", "unit_label", "unit_type", "text"),
    "v10_v11_references": _text(external=lambda t: F.array_join(V.external_refs(t), "|"), internal=lambda t: F.array_join(V.internal_refs(t, U.clause_ref(t)), "|")),
    "v12_requirements": _text(requirements=V.requirement_sentences),
    "v13_conditions": _text(conditions=V.conditions, exceptions=V.exceptions),
    "v14_v18_classes": _text(classes=V.building_classes, scope=V.scope_volume, scope_conditions=V.scope_conditions),
    "v15_constants": _text(value=V.constant_value, name=V.constant_name),
    "v16_v17_rag_text": lambda s, d: derived(s, d).select("volume", "ord", V.rag_text(F.col("unit_type"), F.col("unit_label"), F.col("title"), F.col("text")).alias("rag_text"), V.hierarchy_path(F.col("volume"), F.col("part_code"), F.col("unit_label")).alias("volume_hierarchy"), V.conditionality(F.col("ncc_pathway")).alias("conditionality")),
    "v19_detected_label": _text(label=V.detected_label),
    "v20_defined_terms": _text(term=V.defined_term),
    "v23_formulas": _text(formula=V.formula_json),
    "v25_discipline": _text(discipline=lambda t: V.context_discipline(F.lit(""), V.scope_volume(t), t)),
    "v26_parents": lambda s, d: L.parents_by_level(_chain_rows(s, d)).select("doc_id", "ord", "level", "parent_ord", "order_in_parent"),
    "v29_structure": _text(structure=V.structural_type),
    "v30_context": _contexts,
    "u05_u10_paragraph_units": lambda s, d: P.paragraph_units(_content(s, d), _volume()).drop("pass_no"),
    "u09_table_ownership": lambda s, d: P.table_placement(_content(s, d), X.cells(s, d).where("col_idx > 0 or table_idx % 3 = 0")),
    "u11_table_units": lambda s, d: P.table_units(X.cells(s, d), _volume()).select("doc_id", "place", "volume", "row_type", "unit_type", "clause_ref", "text", "source_location"),
    "u25_table_labels": lambda s, d: P.table_labels(derived(s, d).select(F.expr("ord div 99700").alias("doc_id"), "ord", "clause_ref", F.expr("case when ord % 18 = 0 then concat('Table ', unit_label, ': Sizes ', cast(ord as string)) else title end").alias("heading_text"))).select("doc_id", "ord", "table_id", "table_label"),
    "u26_published_units": lambda s, d: P.publish(_work(s, d)),
    "u27_row_summary": lambda s, d: P.row_summary(_work(s, d)),
    "u28_length_guard": lambda s, d: P.length_guard(X.table(s, d, "documents").select("doc_id", F.expr("repeat(text, 20)").alias("text")), "text").select("doc_id", "n_truncated", F.md5("text").alias("digest")),
    "u01_page_units": _page_units,
    "t01_html_cells": lambda s, d: T.html_cells(X.page_html(s, d)),
    "t02_pipe_tables": lambda s, d: T.pipe_tables(X.cells(s, d)),
    "t03_encoded_cells": lambda s, d: X.cells(s, d).select("doc_id", "table_idx", "row_idx", "col_idx", T.encode_cell(F.col("text"), F.col("colspan"), F.col("rowspan")).alias("cell")),
    "t04_lte_blocks": lambda s, d: T.lte_blocks(X.cells(s, d), _cell_captions(s, d)),
    "t05_shapes": lambda s, d: T.shapes(X.cells(s, d)),
    "u01_nested_blocks": lambda s, d: B.html_blocks(X.nested_pages(s, d)),
    "u01_nested_units": _nested_units,
    "t06_nested_blocks": lambda s, d: B.page_blocks(B.html_blocks(X.nested_pages(s, d))),
    "t06_blocks": lambda s, d: T.blocks_of(T.html_elements(X.page_html(s, d))),
    "t07_captions": lambda s, d: T.captions(_elements(s, d)),
    "t08_nearby_notes": lambda s, d: T.nearby_notes(_elements(s, d)),
    "t09_auto_ids": lambda s, d: T.auto_ids(T.captions(_elements(s, d))).select("doc_id", "dom_idx", "table_id", "title"),
    "t10_nearest_paragraph": lambda s, d: T.nearest_paragraph(_elements(s, d), X.clause_paragraphs(s, d)),
    "t11_page_tables": lambda s, d: T.non_empty_tables(T.html_cells(X.page_html(s, d)), T.html_cells(X.page_html(s, d)).select("doc_id", "table_idx").distinct()),
    "t12_grids": lambda s, d: T.grids(X.cells(s, d)),
    "t13_row_units": lambda s, d: T.row_units(X.cells(s, d)),
}

_LT = "case regexp_extract({0}, '^[A-Z]\\d+([A-Z])\\d+', 1) when 'G' then 'GOVERNING_REQUIREMENT' when 'O' then 'OBJECTIVE' when 'F' then 'FUNCTIONAL_STATEMENT' when 'P' then 'PERFORMANCE_REQUIREMENT' when 'D' then 'DTS_PROVISION' when 'V' then 'VERIFICATION_METHOD' else {1} end"
_REF = clause_ref("text")
_AFTER = strip(f"case when r <> '' and starts_with(text, r) then regexp_replace(substr(text, length(r) + 1), '^\\s*[–—:.-]?\\s*', '') else text end")
_SENT = strip("regexp_extract(a, '^([^.!?]+[.!?])(?:\\s|$)', 1)")
_LINE = strip("regexp_extract(a, '^([^\\n]*)', 1)")
_RANGE = "regexp_extract(case when ord % 3 = 0 then 'table_4' else concat('para_', cast(ord as string), '_to_', cast(ord + 5 as string)) end, 'para_(\\d+)_to_(\\d+)', {0})"
_CELLS = X.CELLS_SQL
_TREF = f"""(select doc_id, table_idx, min_by(ref, (row_idx, col_idx)) ref, min_by(row_idx, (row_idx, col_idx)) ref_row, min_by(t, (row_idx, col_idx)) ref_text from
    (select *, {clause_ref('text')} ref, regexp_extract(text, '(?i)\\b([A-Z]\\d+[A-Z]\\d+[a-z]|[A-Z]\\d+[A-Z]\\d+|[A-Z]\\d+\\.\\d+|[A-Z]\\d+)\\b', 1) t from {_CELLS}) where ref <> '' group by 1, 2)"""
_BARE = f"case when row_idx = ref_row and starts_with({strip('text')}, ref_text) then {strip(f"regexp_replace(substr({strip('text')}, length(ref_text) + 1), '^\\s*[–—:.-]?\\s*', '')")} else {strip('text')} end"
_PIPE_ROWS = f"(select doc_id, table_idx, row_idx, '| ' || string_agg(replace({_BARE}, '|', '\\|'), ' | ' order by col_idx) || ' |' line from {_CELLS} left join {_TREF} using (doc_id, table_idx) group by 1, 2, 3)"
_PIPES = f"""(select doc_id, table_idx, string_agg(case when row_idx = 0 and n > 1 then line || chr(10) || '|' || repeat(' --- |', length(line) - length(replace(line, '|', '')) - 1) else line end, chr(10) order by row_idx) rendered
    from (select *, count(*) over (partition by doc_id, table_idx) n from {_PIPE_ROWS}) group by 1, 2)"""
_VOLUME = "'Vol' || (1 + doc_id % 3)"
_CONTENT = f"(select doc_id, para_idx idx, case when para_idx % 9 = 4 then 'h2' else 'p' end tag, {strip('text')} text, {clause_ref(strip('text'))} ref from {PHRASES_SQL} where {strip('text')} <> '')"
_CSEG = f"(select *, sum(cast(ref <> '' as int)) over (partition by doc_id order by idx) seg from {_CONTENT})"
_ELEM = f"(select doc_id, cast(para_idx * 9 + doc_id % 4 as int) dom_idx, case when para_idx % 7 = 6 then 'table' when para_idx % 9 = 8 then 'h3' else 'p' end tag, text from {X.PARAGRAPHS_SQL})"
_CAP = r"(?i)^(Table|Tab\.?)\s*(\d+(?:\.\d+)?)\b(.*)$"
_NUMBERED = f"(select *, sum(cast(tag <> 'table' as int)) over (partition by doc_id order by dom_idx) block_no from {_ELEM} where tag = 'table' or text <> '')"
_CAPTIONS = f"""(select doc_id, dom_idx, case when cb > block_no - 5 then cid end table_id, case when cb > block_no - 5 then title end title, case when cb > block_no - 5 then cb - 1 end caption_block from
    (select *, last_value(case when c then block_no end ignore nulls) over w cb, last_value(case when c then 'Table ' || regexp_extract(text, '{_CAP}', 2) end ignore nulls) over w cid,
       last_value(case when c then {strip(f"regexp_extract(text, '{_CAP}', 3)")} end ignore nulls) over w title
     from (select *, tag <> 'table' and regexp_matches(text, '{_CAP}') c from {_NUMBERED}) window w as (partition by doc_id order by dom_idx)) where tag = 'table')"""
_PCELLS = r"""(select doc_id, cast(ti - 1 as int) table_idx, cast(ri - 1 as int) row_idx, cast(ci - 1 as int) col_idx, cs[ci] c from (select *, unnest(range(1, len(cs) + 1)) ci from
    (select doc_id, ti, ri, regexp_extract_all(rs[ri], '(?is)<t[dh][^>]*>.*?</t[dh]>') cs from (select *, unnest(range(1, len(rs) + 1)) ri from
    (select doc_id, ti, regexp_extract_all(ts[ti], '(?is)<tr[^>]*>(.*?)</tr>', 1) rs from (select *, unnest(range(1, len(ts) + 1)) ti from
    (select doc_id, regexp_extract_all(html, '(?is)<table[^>]*>(.*?)</table>', 1) ts from """ + X.PAGES_SQL + """)))))))"""
_STRUCT = r"case when regexp_matches(text, '(?i)^volume\s+(one|two|three|\d)\b') then 'VOLUME' when regexp_matches(text, '^SECTION\s+[A-Z]\b') then 'SECTION' when regexp_matches(text, '(?i)^subpart\s+\w+') then 'SUBPART' when regexp_matches(text, '^P(ART|art)\s+[A-Z]?\d+\b') then 'PART' else '' end"
_EXT = _once(r"regexp_extract_all(text, '\b(AS/NZS \d+|AS \d+|ISO \d+)', 1)")
_INT = _once(r"regexp_extract_all(text, '\b([A-Z]\d+[A-Z]\d+)\b', 1)")

#: The whole publication over content and cells; the SQL for pages reads other rows in their place.
_PLACED = f"""(with l as (select doc_id, max(seg) seg from {_CSEG} group by 1), u as (select doc_id, seg, ref from {_CSEG} where ref <> ''),
        t as (select distinct doc_id, table_idx from {_CELLS}), p as (select t.doc_id, table_idx, l.seg, u.ref from t join l using (doc_id) left join u on u.doc_id = l.doc_id and u.seg = l.seg),
        o as (select distinct c.doc_id, c.table_idx from {_CELLS} c join p on p.doc_id = c.doc_id and p.table_idx = c.table_idx where row_idx < 3 and col_idx < 3 and {clause_ref('c.text')} <> '' and {clause_ref('c.text')} <> p.ref)
        select doc_id, table_idx, seg from p anti join o using (doc_id, table_idx))"""
_ITEMS = f"""(select doc_id, seg, 0 kind, cast(idx as bigint) pos, text, tag, ref from {_CSEG}
    union all select doc_id, seg, 1, cast(table_idx as bigint), chr(10) || chr(10) || '[TABLE]' || chr(10) || rendered || chr(10) || '[/TABLE]', 'table', '' from {_PLACED} join {_PIPES} using (doc_id, table_idx))"""
_CUT = "(case when length(whole) > 32767 then substr(whole, 1, 32764) || '...' else whole end)"
_WORK = f"""(with g as (select doc_id, seg, min(pos) filter (kind = 0) f, min_by(ref, (kind, pos)) clause_ref, min_by(tag, (kind, pos)) tag, min_by(text, (kind, pos)) text, string_agg(text, chr(10) || chr(10) order by kind, pos) whole from {_ITEMS} group by 1, 2),
    n as (select doc_id, max(idx) + 1 n from {_CONTENT} group by 1), h as (select *, coalesce(lead(f) over (partition by doc_id order by seg), n) - 1 l, clause_ref r from g join n using (doc_id)),
    a as (select *, {_AFTER} a from h), s as (select *, {_SENT} s, {_LINE} ln from a)
    select doc_id, 0 pass_no, cast(seg as bigint) place, {_VOLUME} volume, 'paragraph' row_type, case when seg > 0 and regexp_matches(lower(tag), '^h[1-6]$') then upper(tag) else '' end heading_level,
      case when seg = 0 then '' when s <> '' and length(s) <= 150 then s when length(ln) <= 100 then ln else substr(ln, 1, 100) end heading_text, {unit_type(_CUT)} unit_type, case when seg > 0 then clause_ref else '' end clause_ref, {_CUT} text,
      case when seg > 0 then 'para_' else 'content_' end || f || '_to_' || l || case when length(whole) > 32767 then '_truncated' else '' end source_location from s
    union all select doc_id, 1, cast(table_idx as bigint), {_VOLUME}, 'table', '', '', {unit_type(_CUT)}, 'table ' || coalesce(ref, cast(table_idx + 1 as varchar)), {_CUT},
      'table_' || table_idx || coalesce('_' || ref, '') || case when length(whole) > 32767 then '_truncated' else '' end from (select *, rendered whole from {_PIPES}) left join {_TREF} using (doc_id, table_idx))"""
_some = lambda a, b: f"case when {a} <> '' then {a} else {b} end"
_json = lambda x: f"coalesce(cast(to_json({x}) as varchar), '[]')"
_TFALL = _some("table_id", "unit_label")
_PUBLISHED = {
    "doc_id": "cast(doc_id as varchar)", "volume": "volume", "source_file": "'{file}'", "path": "volume", "anchor_id": f"case when clause_ref = '' then '' else regexp_replace(upper(volume), '\\s+', '_', 'g') || '::' || {bare_ref('clause_ref')} end",
    "order_in_parent": "cast(ord as int)", **{f"para_{n}": f"coalesce(try_cast(nullif(regexp_extract(source_location, 'para_(\\d+)_to_(\\d+)', {k}), '') as int), 0)" for n, k in (("start", 1), ("end", 2))},
    "unit_label": "unit_label", "unit_type": "unit_type", "compliance_weight": "case when unit_type = 'PERFORMANCE_REQUIREMENT' then 'MANDATORY' when unit_type in ('DTS_PROVISION', 'VERIFICATION_METHOD') then 'OPTIONAL_PATHWAY' else 'NON_MANDATORY' end",
    "title": "heading_text", "text": "text", "text_html": "text", "raw_text": "text", "raw_title": "heading_text", "heading_context": "heading_level", "base_unit_label": "unit_label",
    "defined_term": f"case when unit_type = 'DEFINITION' then {strip("regexp_extract(text, '^([A-Z][^—\\n]{0,80}?)\\s*(?:—|\\bmeans\\b)', 1)")} else '' end",
    "contains_shall": "contains(lower(text), 'shall')", "contains_must": "contains(lower(text), 'must')", "external_refs": _json(_EXT), "internal_refs": _json(f"list_filter({_INT}, lambda x: x <> unit_label)"),
    "ncc_pathway": "pathway", "normative_status": "case when unit_type in ('PERFORMANCE_REQUIREMENT', 'DTS_PROVISION', 'VERIFICATION_METHOD') then 'NORMATIVE' else 'INFORMATIVE' end",
    "conditionality": "case pathway when 'DTS' then 'IF_DTS_SELECTED' when 'PERFORMANCE' then 'IF_PERFORMANCE_SELECTED' else 'ALWAYS' end",
    "conditions_text": "coalesce(array_to_string(regexp_extract_all(text, '(?i)\\b((?:if|where|unless)\\s[^,.;]*)', 1), '|'), '')", "exceptions_text": "coalesce(array_to_string(regexp_extract_all(text, '(?i)\\b((?:except|does not apply)\\b[^,.;]*)', 1), '|'), '')",
    "requirements_list": "coalesce(array_to_string(list_filter(string_split_regex(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: regexp_matches(s, '(?i)\\b(must|shall)\\b')), '|'), '')",
    "standards_referenced": f"coalesce(array_to_string({_EXT}, '|'), '')", "discipline": "discipline", "table_id": "table_id", "table_label": "table_label", "applies_to_volume": "regexp_replace(volume, '^Vol', 'V')", "applies_to_class": _CLASSES,
    "volume_hierarchy": "concat_ws(' > ', nullif(volume, ''), nullif(own_part, ''), nullif(unit_label, ''))", "scope_conditions": f"case when {_CLASSES} <> '' and {_SCOPE} <> '' then 'IF Class ' || {_CLASSES} || ' THEN ' || {_SCOPE} else '' end",
    "formula_json": f"case when {_FORMULA} = '' then '' else cast(to_json({{{{'formula': {strip(_FORMULA)}, 'inputs': coalesce({_once(f"regexp_extract_all(regexp_extract({_FORMULA}, '=(.*)', 1), '([A-Z])', 1)")}, []), 'output': regexp_extract({_FORMULA}, '^([A-Za-z]+)', 1)}}}}) as varchar) end",
    "constant_value": "value", "constant_name": "case when value <> '' then lower(regexp_extract(text, '(?i)\\b(?:the|an?)\\s+([a-z ]+?)\\s+(?:is|must be|shall be)\\b', 1)) else '' end",
    "section_code": _some(f"({section('clause_ref')})", section(_TFALL)), "part_code": "own_part", "indexable": "true", "rag_text": "'[' || unit_type || '] ' || unit_label || chr(10) || 'title: ' || heading_text || chr(10) || 'text: ' || text",
}


def _published_sql(file: str = "", with_discipline: bool = False) -> str:
    """All published columns from the work rows."""
    m = discipline_map()
    looked = f"""select v.*, coalesce(array_to_string(a.disciplines, ', '), array_to_string(b.disciplines, ', '), array_to_string(c.disciplines, ', '), '') discipline from v left join {m} a on a.volume = v.volume and a.code = {last_part('unit_label')}
        left join {m} b on b.volume = v.volume and b.code = regexp_extract({bare_ref('unit_label')}, '^([A-Z])', 1) left join {m} c on c.volume = v.volume and c.code = regexp_extract({bare_ref('unit_label')}, '^([A-Z]\\d+)', 1)"""
    columns = ", ".join(f"{(_PUBLISHED[c].replace("'{file}'", f"'{file}'").replace('{{', '{').replace('}}', '}') if c in _PUBLISHED else "''")} {c}" for c in P.PUBLISHED)
    return f"""with w as (select *, row_number() over (partition by doc_id order by pass_no, place) - 1 ord, {bare_ref('clause_ref')} unit_label, regexp_matches(lower({strip('heading_text')}), '^table\\s') titled from {_WORK}),
        x as (select *, case when (regexp_matches(lower(clause_ref), '^table ') or titled) and regexp_matches({strip('unit_label')}, '^[A-Z]\\d+[A-Z]\\d+[a-zA-Z]?$|^[A-Z]\\d+\\.\\d+$') then unit_label else '' end table_id from w),
        o as (select *, case when table_id <> '' and titled then {strip(f"regexp_extract({strip('heading_text')}, '(?i)^(Table\\s+[^:]+(?::\\s*[^\\n]+)?)', 1)")} end own from x),
        v as (select *, case when table_id = '' then '' else coalesce(own, first_value(own ignore nulls) over (partition by doc_id, table_id order by ord rows between unbounded preceding and current row), '') end table_label from o),
        d as ({looked if with_discipline else "select *, '' discipline from v"}),
        z as (select *, {_some(f"({part('clause_ref')})", part(_TFALL))} own_part, regexp_extract(text, '\\b(\\d+(?:\\.\\d+)?\\s*(?:mm|kPa|m))\\b', 1) as "value",
          case unit_type when 'PERFORMANCE_REQUIREMENT' then 'PERFORMANCE' when 'DTS_PROVISION' then 'DTS' when 'VERIFICATION_METHOD' then 'VERIFICATION' else 'OBJECTIVE' end pathway from d)
        select {columns} from z"""


_PAGE_TAG = r"(?is)<table[^>]*>.*?</table>|</?(?:p|h[1-6]|li|div|blockquote|table|ul|ol)\b[^>]*>"
_PAGE_ELEMENTS = f"""(select doc_id, cast(row_number() over (partition by doc_id order by i) - 1 as int) dom_idx, tag, trim(regexp_replace(regexp_replace(case when tag = 'table' then t else t || seg end, '<[^>]+>', ' ', 'g'), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'), ' ') text
    from (select *, ts[i] t, ss[i + 1] seg, lower(regexp_extract(ts[i], '^<(\\w+)', 1)) tag from (select *, unnest(range(1, len(ts) + 1)) i from (select doc_id, regexp_extract_all(html, '{_PAGE_TAG}') ts, string_split_regex(html, '{_PAGE_TAG}') ss from {X.PAGES_SQL})))
    where tag not in ('', 'ul', 'ol') and (tag <> 'table' or regexp_matches(t, '(?is)</table>$')))"""


def _of_pages(sql: str, nested: bool = False) -> str:
    """The same SQL over the content and cells of pages."""
    rows = f"(select doc_id, start idx, tag, text from ({_BLOCKS} select * from blocks) where tag <> 'table' and not in_table)" if nested else f"(select doc_id, dom_idx idx, tag, text from {_PAGE_ELEMENTS} where tag <> 'table')"
    content = f"(select doc_id, idx, tag, {strip('text')} text, {clause_ref(strip('text'))} ref from {rows} where {strip('text')} <> '')"
    cells = ORACLES["t01_html_cells"]
    return sql.replace(_CELLS, f"({cells.replace(X.PAGES_SQL, X.NESTED_PAGES_SQL) if nested else cells})").replace(_CONTENT, content)


_TAG = r"(?i)</?(?:p|h[1-6]|div|li|blockquote|table|ul|ol)\b[^>]*>"
_BLOCKS = f"""with h as (select doc_id, regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g') h from {X.NESTED_PAGES_SQL}),
    a as (select doc_id, regexp_extract_all(h, '{_TAG}') ts, string_split_regex(h, '{_TAG}')[2:] ss from h),
    t as (select doc_id, cast(i - 1 as int) pos, lower(regexp_extract(ts[i], '^</?(\\w+)', 1)) tag, not starts_with(ts[i], '</') op, ss[i] seg from (select *, unnest(range(1, len(ts) + 1)) i from a)),
    l as (select *, case when op then 0 else 1 end + sum(case when op then 1 else -1 end) over (partition by doc_id, tag order by pos) depth,
        case when tag in ('ul', 'ol') and not op then 1 else 0 end + sum(case when tag not in ('ul', 'ol') then 0 when op then 1 else -1 end) over (partition by doc_id order by pos) lists,
        lead(pos) over (partition by doc_id order by pos) nxt, max(pos) over (partition by doc_id) + 1 n from t),
    b as (select doc_id, pos, nxt fin, tag, n from l where op and regexp_matches(tag, '^(p|h[1-6])$')
      union all select doc_id, pos, fin, tag, n from (select *, lead(pos) over (partition by doc_id, lists order by pos) fin from l where tag = 'li' or (tag in ('ul', 'ol') and not op)) where tag = 'li' and op
      union all select doc_id, pos, fin, tag, n from (select *, lead(pos) over (partition by doc_id, tag, depth order by pos) fin from l where tag in ('div', 'blockquote', 'table')) where op),
    i as (select doc_id, pos start, coalesce(fin, n) fin, tag from b),
    blocks as (select i.doc_id, i.start, i.tag, (select count(*) from i o where o.doc_id = i.doc_id and o.start < i.start and o.fin > i.start) depth, (select max(o.start) from i o where o.doc_id = i.doc_id and o.start < i.start and o.fin > i.start) parent,
        exists (select 1 from i o where o.doc_id = i.doc_id and o.tag = 'table' and o.start < i.start and o.fin > i.start) in_table,
        trim(regexp_replace(regexp_replace((select string_agg(seg, ' ' order by pos) from t where t.doc_id = i.doc_id and t.pos >= i.start and t.pos < i.fin), '<[^>]+>', ' ', 'g'), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'), ' ') text from i)"""

ORACLES = {
    "u02_u20_codes": f"select volume, ord, clause_ref, section_code, part_code, anchor_id, normative_status, ncc_pathway, compliance_weight, applies_to_volume, indexable, 'Vol' || upper(regexp_replace(lower(volume), '^vol', '')) volume_label, {_LT.format('unit_label', "'OTHER'")} label_type, regexp_matches(table_id, '^[A-Z]\\d+[A-Z]\\d+[a-zA-Z]?$|^[A-Z]\\d+\\.\\d+$') good_table_id from {DERIVED_SQL}",
    "u03_clause_refs": _sql(ref=_REF),
    "u07_heading_text": f"""select doc_id, para_idx, case when s <> '' and length(s) <= 150 then s when length(l) <= 100 then l else substr(l, 1, 100) end heading,
        case when s <> '' and length(s) <= 150 then s when length(l) <= 100 then l else regexp_extract(l, '^(.{{1,100}})(?:\\s|$)', 1) end heading_at_word
        from (select *, {_SENT} s, {_LINE} l from (select *, {_AFTER} a from (select *, {_REF} r from {PHRASES_SQL})))""",
    "u13_unit_type": _sql(unit_type=unit_type("text")),
    "u17_paragraph_range": f"select volume, ord, coalesce(try_cast(nullif({_RANGE.format(1)}, '') as int), 0) \"first\", coalesce(try_cast(nullif({_RANGE.format(2)}, '') as int), 0) \"last\" from {X.UNITS_SQL}",
    "u22_modality": _sql(contains_shall="lower(text) like '%shall%'", contains_must="lower(text) like '%must%'"),
    "v01_variation_headings": _sql(state=f"upper(regexp_extract(text, '{_RX}', 1))", label=_LABEL, body=_BODY),
    "v02_base_labels": _sql(base=f"regexp_extract({_LABEL}, '([A-Z]{{1,2}}\\d+[A-Z]?\\d*)(?:\\(\\d+\\))?$', 1)", subclause=f"regexp_extract({_LABEL}, '(\\(\\d+\\))$', 1)"),
    "v03_continuations": f"""with s as (select *, sum(cast(h as int)) over (partition by doc_id order by para_idx) seg from (select *, regexp_matches(text, '{_RX}') h from {PHRASES_SQL})),
        b as (select *, case when h then {_BODY} else {strip('text')} end t from s where seg > 0)
        select doc_id, cast(seg as bigint) seg, min_by(upper(regexp_extract(text, '{_RX}', 1)) || ' ' || {_LABEL}, para_idx) label, coalesce(string_agg(t, ' ' order by para_idx) filter (t <> ''), '') text from b group by doc_id, seg""",
    "v04_actions": _sql(action=_ACTION),
    "v07_markers": f"select volume, ord, unnest(regexp_extract_all(marked, '\\bNSW\\s+([A-Z]\\d+[A-Z]\\d+)\\((\\d+)\\)')) marker from {DERIVED_SQL}",
    "v08_unextracted": f"""select doc_id, para_idx, substr(text, 1, 220) preview from {PHRASES_SQL} where regexp_matches(text, '\\b(SA|NSW|VIC|QLD|WA|TAS|ACT|NT)\\s+[A-Z]\\d+[A-Z]\\d+(\\(\\d+\\))?')
        and regexp_matches(text, '(?i)\\b(delete|insert|replace)\\b|does not apply|not apply|left blank') and not (lower(text) like '%refer to%' and not regexp_matches(lower(text), '\\b(delete|insert|replace)\\b|does not apply|left blank')) order by doc_id, para_idx limit 15""",
    "v09_needle": f"select volume, ord, unit_label, unit_type, text from {X.UNITS_SQL} where text like '%AS 1001%' or raw_text like '%AS 1001%' order by volume, ord limit 10",
    "v10_v11_references": _sql(external=f"coalesce(array_to_string({_EXT}, '|'), '')", internal=f"coalesce(array_to_string(list_filter({_INT}, lambda x: x <> {_REF}), '|'), '')"),
    "v12_requirements": _sql(requirements="coalesce(array_to_string(list_filter(string_split_regex(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: regexp_matches(s, '(?i)\\b(must|shall)\\b')), '|'), '')"),
    "v13_conditions": _sql(conditions="coalesce(array_to_string(regexp_extract_all(text, '(?i)\\b((?:if|where|unless)\\s[^,.;]*)', 1), '|'), '')", exceptions="coalesce(array_to_string(regexp_extract_all(text, '(?i)\\b((?:except|does not apply)\\b[^,.;]*)', 1), '|'), '')"),
    "v14_v18_classes": _sql(classes=_CLASSES, scope=_SCOPE, scope_conditions=f"case when {_CLASSES} <> '' and {_SCOPE} <> '' then 'IF Class ' || {_CLASSES} || ' THEN ' || {_SCOPE} else '' end"),
    "v15_constants": _sql(value="regexp_extract(text, '\\b(\\d+(?:\\.\\d+)?\\s*(?:mm|kPa|m))\\b', 1)", name="lower(regexp_extract(text, '(?i)\\b(?:the|an?)\\s+([a-z ]+?)\\s+(?:is|must be|shall be)\\b', 1))"),
    "v16_v17_rag_text": f"select volume, ord, '[' || unit_type || '] ' || unit_label || chr(10) || 'title: ' || title || chr(10) || 'text: ' || text rag_text, concat_ws(' > ', nullif(volume, ''), nullif(part_code, ''), nullif(unit_label, '')) volume_hierarchy, case ncc_pathway when 'DTS' then 'IF_DTS_SELECTED' when 'PERFORMANCE' then 'IF_PERFORMANCE_SELECTED' else 'ALWAYS' end conditionality from {DERIVED_SQL}",
    "v19_detected_label": _sql(label="coalesce(nullif(regexp_extract(text, '\\b([A-Z]\\d+[PDV]\\d+[A-Z]?)\\b', 1), ''), nullif(regexp_extract(text, '\\b([A-Z]\\d+[A-Z]\\d+[A-Z]?)\\b', 1), ''), nullif(regexp_extract(text, '\\b([A-Z]{1,2}\\d+[A-Z]{1,2}\\d+)\\b', 1), ''), '')"),
    "v20_defined_terms": _sql(term=strip("regexp_extract(text, '^([A-Z][^—\\n]{0,80}?)\\s*(?:—|\\bmeans\\b)', 1)")),
    "v23_formulas": _sql(formula=f"case when {_FORMULA} = '' then '' else cast(to_json({{'formula': {strip(_FORMULA)}, 'inputs': {_once(f"regexp_extract_all(regexp_extract({_FORMULA}, '=(.*)', 1), '([A-Z])', 1)")}, 'output': regexp_extract({_FORMULA}, '^([A-Za-z]+)', 1)}}) as varchar) end"),
    "v25_discipline": _sql(discipline=f"case when {_SCOPE} = 'Vol3' then 'Plumbing' when regexp_matches(text, '(?i)\\b(fire|smoke|exit)') then 'Fire Safety' when regexp_matches(text, '(?i)\\b(access|ramp|lift)') then 'Access' when regexp_matches(text, '(?i)\\b(structur|footing|load)') then 'Structural' else '' end"),
    "v26_parents": f"""with r as (select doc_id, cast(para_idx as bigint) ord, cast(case {_STRUCT} when 'VOLUME' then 0 when 'SECTION' then 1 when 'PART' then 2 when 'SUBPART' then 3 else 4 end as int) level from {PHRASES_SQL}),
        p as (select r.*, (select max(x.ord) from r x where x.doc_id = r.doc_id and x.ord < r.ord and x.level < r.level) parent_ord from r)
        select *, cast(row_number() over (partition by doc_id, parent_ord order by ord) - 1 as int) order_in_parent from p""",
    "v29_structure": _sql(structure=_STRUCT),
    "v30_context": f"""select doc_id, para_idx, {_LT.format(_REF, "coalesce(c, 'OTHER')")} unit_type, coalesce(ph, '') part_heading, {_LT.format(_REF, "''")} = '' context_inferred from
        (select *, last_value(case when starts_with(text, 'Objectives') then 'OBJECTIVE' when starts_with(text, 'Functional Statements') then 'FUNCTIONAL_STATEMENT' when starts_with(text, 'Performance Requirements') then 'PERFORMANCE_REQUIREMENT'
            when starts_with(text, 'Verification Methods') then 'VERIFICATION_METHOD' when starts_with(text, 'Deemed-to-Satisfy') then 'DTS_PROVISION' end ignore nulls) over w c,
          last_value(case when {_STRUCT} = 'PART' then regexp_extract(text, '^P(?:ART|art)\\s+(\\S+)', 1) end ignore nulls) over w ph from {PHRASES_SQL} window w as (partition by doc_id order by para_idx))""",
    "u05_u10_paragraph_units": f"""with g as (select doc_id, seg, min(idx) f, min_by(ref, idx) clause_ref, min_by(tag, idx) tag, min_by(text, idx) text, string_agg(text, chr(10) || chr(10) order by idx) whole from {_CSEG} group by 1, 2),
        n as (select doc_id, max(idx) + 1 n from {_CONTENT} group by 1),
        h as (select *, coalesce(lead(f) over (partition by doc_id order by seg), n) - 1 l, clause_ref r from g join n using (doc_id)),
        a as (select *, {_AFTER} a from h), s as (select *, {_SENT} s, {_LINE} ln from a)
        select doc_id, cast(seg as bigint) place, {_VOLUME} volume, 'paragraph' row_type, case when seg > 0 and tag = 'h2' then 'H2' else '' end heading_level,
          case when seg = 0 then '' when s <> '' and length(s) <= 150 then s when length(ln) <= 100 then ln else substr(ln, 1, 100) end heading_text,
          {unit_type("(case when length(whole) > 32767 then substr(whole, 1, 32764) || '...' else whole end)")} unit_type, case when seg > 0 then clause_ref else '' end clause_ref,
          case when length(whole) > 32767 then substr(whole, 1, 32764) || '...' else whole end text,
          case when seg > 0 then 'para_' else 'content_' end || f || '_to_' || l || case when length(whole) > 32767 then '_truncated' else '' end source_location from s""",
    "u09_table_ownership": f"""with l as (select doc_id, max(seg) seg from {_CSEG} group by 1), u as (select doc_id, seg, ref from {_CSEG} where ref <> ''),
        t as (select distinct doc_id, table_idx from {_CELLS}), p as (select t.doc_id, table_idx, l.seg, u.ref from t join l using (doc_id) left join u on u.doc_id = l.doc_id and u.seg = l.seg),
        o as (select distinct c.doc_id, c.table_idx from {_CELLS} c join p on p.doc_id = c.doc_id and p.table_idx = c.table_idx where (col_idx > 0 or c.table_idx % 3 = 0) and row_idx < 3 and col_idx < 3 and {clause_ref('c.text')} <> '' and {clause_ref('c.text')} <> p.ref)
        select doc_id, table_idx, cast(seg as bigint) seg from p anti join o using (doc_id, table_idx)""",
    "u11_table_units": f"""select doc_id, cast(table_idx as bigint) place, {_VOLUME} volume, 'table' row_type, {unit_type('rendered')} unit_type, 'table ' || coalesce(ref, cast(table_idx + 1 as varchar)) clause_ref, rendered text,
        'table_' || table_idx || coalesce('_' || ref, '') source_location from {_PIPES} left join {_TREF} using (doc_id, table_idx)""",
    "u25_table_labels": f"""with h as (select ord // 99700 doc_id, ord, clause_ref, case when ord % 18 = 0 then concat('Table ', unit_label, ': Sizes ', cast(ord as string)) else title end h from {DERIVED_SQL}),
        t as (select *, {bare_ref('clause_ref')} l, regexp_matches(lower({strip('h')}), '^table\\s') titled from h),
        x as (select *, case when (regexp_matches(lower(clause_ref), '^table ') or titled) and regexp_matches(l, '^[A-Z]\\d+[A-Z]\\d+[a-zA-Z]?$|^[A-Z]\\d+\\.\\d+$') then l else '' end table_id from t),
        o as (select *, case when table_id <> '' and titled then {strip(f"regexp_extract({strip('h')}, '(?i)^(Table\\s+[^:]+(?::\\s*[^\\n]+)?)', 1)")} end own from x)
        select doc_id, ord, table_id, case when table_id = '' then '' else coalesce(own, first_value(own ignore nulls) over (partition by doc_id, table_id order by ord rows between unbounded preceding and current row), '') end table_label from o""",
    "u28_length_guard": "select doc_id, cast(length(t) > 32767 as int) n_truncated, md5(case when length(t) > 32767 then substr(t, 1, 32764) || '...' else t end) digest from (select doc_id, repeat(text, 20) t from documents)",
    "u01_nested_blocks": f"{_BLOCKS} select * from blocks",
    "t06_nested_blocks": f"{_BLOCKS} select doc_id, cast(row_number() over (partition by doc_id order by start) as int) block_no, start, tag, text from blocks where tag <> 'table' and not in_table and text <> ''",
    "u26_published_units": _published_sql(),
    "u27_row_summary": f"select count(*) filter (row_type = 'paragraph') paragraphs, count(*) filter (row_type = 'table') tables, count(*) total_rows, count(*) filter (length(text) >= 32767) at_limit from {_WORK}",
    "t06_blocks": f"select doc_id, dom_idx, tag, text, cast(row_number() over (partition by doc_id order by dom_idx) as int) block_no from {_PAGE_ELEMENTS} where tag <> 'table' and text <> ''",
    "t01_html_cells": f"""select doc_id, table_idx, row_idx, col_idx, trim(regexp_replace(regexp_replace(c, '<[^>]+>', ' ', 'g'), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g'), ' ') text, lower(regexp_extract(c, '(?i)^<(t[dh])', 1)) tag,
        cast(coalesce(nullif(regexp_extract(c, '(?i)^<t[dh][^>]*\\bcolspan=["'']?(\\d+)', 1), ''), '1') as int) colspan, cast(coalesce(nullif(regexp_extract(c, '(?i)^<t[dh][^>]*\\browspan=["'']?(\\d+)', 1), ''), '1') as int) rowspan from {_PCELLS}""",
    "t02_pipe_tables": f"select * from {_PIPES}",
    "t03_encoded_cells": f"select doc_id, table_idx, row_idx, col_idx, replace(trim(regexp_replace(text, '\\s+', ' ', 'g'), ' '), '|', '\\|') || case when colspan > 1 then '{{colspan=' || colspan || '}}' else '' end || case when rowspan > 1 then '{{rowspan=' || rowspan || '}}' else '' end cell from {_CELLS}",
    "t04_lte_blocks": f"""with c as (select *, replace(trim(regexp_replace(text, '\\s+', ' ', 'g'), ' '), '|', '\\|') || case when colspan > 1 then '{{colspan=' || colspan || '}}' else '' end e from {_CELLS}),
        r as (select doc_id, table_idx, row_idx, count(*) n, '| ' || string_agg(e, ' | ' order by col_idx) || ' |' line from c group by 1, 2, 3)
        select doc_id, table_idx, concat_ws(chr(10), '[LTE_TABLE]', 'id: Table ' || table_idx, 'title: Sizes', 'source: docx', 'location: paragraphIndex=-1', 'shape: rows=' || count(*) || ' cols=' || max(n), 'notes:', '', 'grid:', string_agg(line, chr(10) order by row_idx), '[/LTE_TABLE]') lte from r group by 1, 2""",
    "t05_shapes": f"select doc_id, table_idx, count(*) n_rows, max(n) n_cols from (select doc_id, table_idx, row_idx, count(*) n from {_CELLS} group by 1, 2, 3) group by 1, 2",
    "t07_captions": f"select doc_id, dom_idx, table_id, title, cast(caption_block as bigint) caption_block from {_CAPTIONS}",
    "t08_nearby_notes": f"""with t as (select doc_id, dom_idx t, lag(dom_idx) over w bt, lead(dom_idx) over w aft from {_ELEM} where tag = 'table' window w as (partition by doc_id order by dom_idx)),
        m as (select t.*, e.dom_idx b, tag, text, case when e.dom_idx > t then 0 else 1 end side from t join {_ELEM} e on e.doc_id = t.doc_id and e.tag <> 'table' and text <> '' and abs(e.dom_idx - t) <= 30),
        n as (select *, row_number() over (partition by doc_id, t, side order by abs(b - t)) nth from m),
        s as (select *, max(cast(tag = 'h3' or coalesce(abs(bt - b) < 50, false) or coalesce(abs(aft - b) < 50, false) as int)) over (partition by doc_id, t order by side, nth) stopped from n where nth <= 3),
        k as (select doc_id, t, text, min((side, nth)) o from s where stopped = 0 and regexp_matches(text, '(?i)^(NOTE|NOTES|Footnote|Footnotes)\\b') group by 1, 2, 3)
        select t.doc_id, t.t dom_idx, coalesce(string_agg(text, chr(10) order by o), '') notes from t left join k on k.doc_id = t.doc_id and k.t = t.t group by 1, 2""",
    "t09_auto_ids": f"select doc_id, dom_idx, coalesce(table_id, format('Table-AUTO-{{:03d}}', row_number() over (partition by doc_id, table_id is null order by dom_idx))) table_id, coalesce(title, '') title from {_CAPTIONS}",
    "t10_nearest_paragraph": f"""with k as (select doc_id, key, max(para_idx) para_idx from (select doc_id, para_idx, {strip('text')} key from {X.PARAGRAPHS_SQL} where {strip('text')} <> ''
          union all select doc_id, para_idx, substr({strip('text')}, 1, 50) from {X.PARAGRAPHS_SQL} where length({strip('text')}) > 50) group by 1, 2),
        b as (select n.doc_id, block_no, coalesce(x.para_idx, y.para_idx) para_idx from {_NUMBERED} n left join k x on x.doc_id = n.doc_id and x.key = n.text left join k y on y.doc_id = n.doc_id and y.key = substr(n.text, 1, 50) where tag <> 'table'),
        t as (select doc_id, dom_idx, block_no from {_NUMBERED} where tag = 'table')
        select t.doc_id, t.dom_idx, coalesce(max_by(b.para_idx, b.block_no), -1) paragraph_index from t left join b on b.doc_id = t.doc_id and b.para_idx is not null and b.block_no between t.block_no - 4 and t.block_no group by 1, 2""",
    "t11_page_tables": f"select distinct doc_id, table_idx from {_PCELLS}",
    "t12_grids": f"""with r as (select doc_id, table_idx, row_idx, list(text order by col_idx) t from {_CELLS} group by 1, 2, 3), g as (select doc_id, table_idx, list(t order by row_idx) r from r group by 1, 2)
        select doc_id, table_idx, cast(to_json({{'headers': r[1], 'rows': r[2:]}}) as varchar) table_grid_json, array_to_string(list_transform(r[2:], lambda t: t[1] || '=' || t[2]), '|') table_key_values from g""",
    "t13_row_units": f"select doc_id, table_idx, row_idx, 'TABLE_ROW' unit_type, '| ' || string_agg(text, ' | ' order by col_idx) || ' |' text from {_CELLS} group by 1, 2, 3",
}
ORACLES["u01_page_units"] = _of_pages(_published_sql("pages", with_discipline=True))
ORACLES["u01_nested_units"] = _of_pages(_published_sql("pages"), nested=True)
