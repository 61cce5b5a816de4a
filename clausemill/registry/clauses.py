"""Clause detection, editing, alignment and the clean clause table."""

from __future__ import annotations

from pyspark.sql import functions as F

from clausemill.operators import alignment as G
from clausemill.operators import clauses as C
from clausemill.operators import normalize as N
from clausemill.operators import trees as R
from clausemill.sources import fixtures as X

from .sql import collapse, strip


def _p(s, d):
    return X.clause_paragraphs(s, d)


_SELECTED = "para_idx % 3 = 1"
_MARKS = "case when para_idx % 2 = 0 then text else 'other' end mark_text, concat(' M', cast(para_idx as string), ' ') mark_number"
_ELEMENTS = "case para_idx % 3 when 0 then concat(' ', text, ' ') when 1 then concat(text, ' tail') else concat('zz ', text) end text"
_ITEMS = "regexp_replace(text, '^E[0-9]+[.][0-9]+', '') text"


def _marks(s, d):
    return _p(s, d).where("para_idx % 5 = 2 or para_idx % 8 = 0").selectExpr("doc_id", "para_idx", *X.split_columns(_MARKS))


def _elements(s, d):
    return _p(s, d).selectExpr("doc_id", "para_idx el_idx", _ELEMENTS)


def _clean(s, d):
    return N.clean_clauses(X.clause_sheet(s, d), "AS3000")


def _tree(s, d):
    return N.clean_clauses(X.tree_sheet(s, d), "AS3000")


def _numbers(s, d):
    number = N.clause_number(F.col("clause_number"))
    rows = X.clause_sheet(s, d).select("idx", N.bare_number(F.col("clause_number")).alias("bare"), N.join_single(N.bare_number(F.col("clause_number"))).alias("single"), number.alias("number"), N.corruption_note(number).alias("note"))
    return rows.withColumns({"level": N.level(F.col("number")), "parent": N.parent_number(F.col("number")), "appendix": N.is_appendix(F.col("number"))})


QUERIES = {
    "c01_exclusion": lambda s, d: _p(s, d).select("doc_id", "para_idx", C.is_excluded(F.col("text")).alias("excluded")),
    "c02_c03_headings": lambda s, d: C.headings(_p(s, d)),
    "c04_note_types": lambda s, d: _p(s, d).select("doc_id", "para_idx", C.note_type(F.col("text")).alias("note_type")).where("note_type is not null"),
    "c05_segments": lambda s, d: C.segments(_p(s, d)).where("seg > 0").select("doc_id", "para_idx", "is_heading", "seg"),
    "c05_segment_bounds": lambda s, d: C.segment_bounds(_p(s, d)),
    "c05_c07_clauses": lambda s, d: C.joined(C.clauses(_p(s, d))),
    "c08_coverage": lambda s, d: C.coverage(C.clauses(_p(s, d))),
    "c09_manual_marks": lambda s, d: C.toggle_marks(C.clauses(_p(s, d)).select("doc_id", "para_idx", "clause_id", "clause_number", "text"), _marks(s, d)).select("doc_id", "para_idx", "clause_number", "marked_by"),
    "c10_c11_delete_and_merge": lambda s, d: C.delete_and_merge(C.headings(_p(s, d)).withColumnRenamed("clause_text", "text"), F.expr(_SELECTED)),
    "c12_align": lambda s, d: G.align(_elements(s, d), _p(s, d)),
    "c13_best_element": lambda s, d: G.best_element(C.headings(_p(s, d)), _p(s, d), _elements(s, d)),
    "c14_export": lambda s, d: C.joined(C.clauses(_p(s, d))).select("clause_number", F.col("text").alias("clause_text"), "notes", "exceptions", "warnings", "jurisdiction"),
    "c15_preview": lambda s, d: C.preview(X.clause_sheet(s, d).select("idx", "clause_number", "clause_text"), "idx"),
    "c16_large_documents": lambda s, d: C.large_documents(_p(s, d), max_paragraphs=20, max_bytes=8000),
    "c17_subclauses": lambda s, d: C.subclauses(_p(s, d).selectExpr("doc_id", "para_idx", _ITEMS)).select("doc_id", "para_idx", "item"),
    "c18_align_by_map": lambda s, d: G.align_by_map(_elements(s, d), _p(s, d), C.headings(_p(s, d))),
    "c19_align_first_containment": lambda s, d: G.align_first_containment(_elements(s, d), _p(s, d)),
    "n01_n07_numbers": _numbers,
    "n05_n12_clean_clauses": _clean,
    "n08_clauses_by_standard": lambda s, d: N.clean_clauses(X.clause_sheet(s, d).withColumn("std", F.expr("concat('AS', cast(3000 + idx % 4 as string))")), F.col("std")).select("id", "clause_number", "parent_id", "source_rows"),
    "n13_children": lambda s, d: N.children(_tree(s, d)),
    "n13_ancestors": lambda s, d: R.ancestors(_tree(s, d)),
    "n13_tree": lambda s, d: R.tree_measures(_tree(s, d)),
    "n13_orphans": lambda s, d: N.orphans(_clean(s, d)),
}

_U = "kW|W|A|V|Hz|mm|kg|m|cm|km|MHz|GHz"
_EXCLUDED = f"""(regexp_matches({strip('text')}, '(?i)^(table|tab\\.|tab\\s|figure|fig\\.|fig\\s)|^\\s*page\\s+\\d+')
    or regexp_matches(substr({strip('text')}, 1, 20), '(?i)^\\d+\\.?\\d*\\s*({_U})\\b') or regexp_matches({strip('text')}, '(?i)^\\d+\\.?\\d*\\s*({_U})\\s*$')
    or length({strip('text')}) < 3)"""
_H = r"^\s*((?:\d+(?:\.\d+){1,4})|(?:[A-Z]{1,2}\d+(?:\.\d+)*[a-z]?)|(?:[A-Z]\.\d+(?:\.\d+){0,3}))(\([a-zivx]+\))?\s*[ .\-–:]*\s*(.*)$"
_HEAD = f"(not {_EXCLUDED} and regexp_matches(text, '{_H}'))"
_NUMBER = f"regexp_extract(text, '{_H}', 1) || regexp_extract(text, '{_H}', 2)"
_KIND = f"""case when regexp_matches({strip('text')}, '(?i)^(NOTE|NOTES)\\b') then 'note' when regexp_matches({strip('text')}, '(?i)^(EXCEPTION|EXCEPT)\\b') then 'exception'
    when regexp_matches({strip('text')}, '(?i)^(WARNING|CAUTION)\\b') then 'warning' when regexp_matches({strip('text')}, '(?i)^(New Zealand only|NZ only)\\b') then 'jurisdiction' end"""
_P = X.PARAGRAPHS_SQL
_SEG = f"(select *, sum(cast(h as int)) over (partition by doc_id order by para_idx) seg from (select *, {_HEAD} h from {_P}))"
_HEADINGS = f"(select doc_id, para_idx, {_NUMBER} clause_number, 'clause-' || para_idx || '-' || ({_NUMBER}) clause_id, coalesce(nullif({strip(f"regexp_extract(text, '{_H}', 3)")}, ''), text) clause_text from {_P} where {_HEAD})"
_of = lambda k: f"string_agg(t, chr(10) || chr(10) order by para_idx) filter (k = '{k}')"
_CLAUSES = f"""(select doc_id, cast(seg as bigint) seg, min(para_idx) para_idx, min_by({_NUMBER}, para_idx) clause_number,
    'clause-' || min(para_idx) || '-' || min_by({_NUMBER}, para_idx) clause_id, string_agg(t, ' ' order by para_idx) filter (k in ('heading', 'text')) text,
    {_of('note')} notes, {_of('exception')} exceptions, {_of('warning')} warnings, {_of('jurisdiction')} jurisdiction
    from (select *, {strip('text')} t, case when h then 'heading' else coalesce({_KIND}, 'text') end k from {_SEG} where seg > 0) where h or t <> '' group by doc_id, seg)"""
_EL = f"(select doc_id, para_idx el_idx, {strip('text')} t from (select doc_id, para_idx, {_ELEMENTS} from {_P}))"
_PT = f"(select doc_id, para_idx, {strip('text')} p from {_P})"
_KEYS = f"(select doc_id, key, max(para_idx) para_idx from (select doc_id, para_idx, p key from {_PT} where p <> '' union all select doc_id, para_idx, substr(p, 1, 50) from {_PT} where length(p) > 50) group by doc_id, key)"
_BARE = collapse(f"regexp_replace({strip('clause_number')}, '(?i)^Clause\\s+', '')")
_NUM = f"""(select *, regexp_replace(single, '(\\d+(?:\\.\\d+)+),(\\d+\\.\\d+)', '\\1.\\2', 'g') number from
    (select *, regexp_replace(bare, '(\\d+\\.\\d+),(\\d([^.]|$))', '\\1.\\2', 'g') single from (select *, {_BARE} bare from {X.SHEET_SQL})))"""
_NOTE = """coalesce('POSSIBLE OCR CLAUSE CORRUPTION: ' || list_filter(regexp_extract_all(number, '\\d+(?:\\.\\d+){2,},\\d+(?:\\.\\d+){2,}'),
    lambda m: cast(regexp_extract(m, '(\\d+),', 1) as bigint) <> cast(regexp_extract(m, ',(\\d+)', 1) as bigint))[-1], '')"""
_PARTS = f"list_filter(string_split({strip("regexp_replace(number, '(?i)\\s*\\([a-zivx]+\\)\\s*$', '')")}, '.'), lambda x: x <> '')"
_PARENT = f"case when len({_PARTS}) > 1 then array_to_string({_PARTS}[:-2], '.') else '' end"
_APPENDIX = "regexp_matches(number, '^[A-Z](?:\\.\\d+|\\d+|$)')"
_CLEAN = f"""(select 'AS3000:' || number || case when nth > 1 then '#' || nth else '' end id, number clause_number, heading,
    case when heading <> '' and others <> '' then others else whole end body,
    array_to_string(list_filter([notes, case when warnings <> '' then 'WARNING: ' || warnings end, case when jurisdiction <> '' then 'JURISDICTION: ' || jurisdiction end, {_NOTE}], lambda x: x <> ''), chr(10) || chr(10)) notes,
    exceptions, cast(len({_PARTS}) as int) "level", {_PARENT} parent_number, case when {_PARENT} <> '' then 'AS3000:' || ({_PARENT}) else '' end parent_id,
    {_APPENDIX} appendix_flag, true embeddable, {strip("case when heading <> '' and others <> '' then others else whole end")} = '' is_heading_only, false had_duplicate_merge, '[' || idx || ']' source_rows
    from (select *, case when starts_with(lower(first), lower(number)) and regexp_matches(substr(first, length(number) + 1), '^\\s+.') and length({strip('substr(first, length(number) + 1)')}) <= 120 then {strip('substr(first, length(number) + 1)')}
        when first <> '' and (first = upper(first) or regexp_matches(first, '^[A-Z][a-z]+(\\s+[A-Z][a-z]+)*$')) and length(first) <= 120 then first else '' end heading
      from (select *, coalesce(lines[1], '') first, array_to_string(lines[2:], chr(10)) others, row_number() over (partition by number order by idx) nth
        from (select *, {strip('clause_text')} whole, list_filter(list_transform(string_split({strip('clause_text')}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '') lines from {_NUM} where number <> ''))))"""

CLEAN_SQL = _CLEAN
_TREE = _CLEAN.replace(X.SHEET_SQL, X.TREE_SHEET_SQL)
_UP = f"""with recursive c as (select id, parent_id from {_TREE}), up as (select c.id, c.parent_id ancestor_id, cast(1 as bigint) distance from c join c p on p.id = c.parent_id
    union all select up.id, c.parent_id, up.distance + 1 from up join c on c.id = up.ancestor_id join c p on p.id = c.parent_id)"""

ORACLES = {
    "c01_exclusion": f"select doc_id, para_idx, {_EXCLUDED} excluded from {_P}",
    "c02_c03_headings": f"select * from {_HEADINGS}",
    "c04_note_types": f"select doc_id, para_idx, {_KIND} note_type from {_P} where {_KIND} is not null",
    "c05_segments": f"select doc_id, para_idx, h is_heading, cast(seg as bigint) seg from {_SEG} where seg > 0",
    "c05_segment_bounds": f"select doc_id, para_idx first_para, coalesce(lead(para_idx) over (partition by doc_id order by para_idx) - 1, last) last_para from (select *, max(para_idx) over (partition by doc_id) last from (select *, {_HEAD} h from {_P})) where h",
    "c05_c07_clauses": f"select * from {_CLAUSES}",
    "c08_coverage": f"select count(*) clauses, count(notes) with_notes, count(exceptions) with_exceptions from {_CLAUSES}",
    "c09_manual_marks": f"""
        with c as (select doc_id, para_idx, clause_id, clause_number, text from {_CLAUSES}),
        m as (select doc_id, para_idx, {_MARKS} from {_P} where para_idx % 5 = 2 or para_idx % 8 = 0),
        j as (select c.doc_id, c.clause_id, min(case when {strip('mark_text')} <> '' and ({strip('c.text')} = {strip('mark_text')} or contains({strip('mark_text')}, substr({strip('c.text')}, 1, 50))) then c.clause_id end) over (partition by c.doc_id, c.para_idx) first from c join m using (doc_id, para_idx)),
        g as (select doc_id, clause_id from j where first is null or first = clause_id)
        select doc_id, para_idx, clause_number, 'auto' marked_by from c anti join g using (doc_id, clause_id)
        union all select doc_id, para_idx, {strip('mark_number')}, 'manual' from m anti join c using (doc_id, para_idx)""",
    "c10_c11_delete_and_merge": f"""
        with t as (select *, last_value(case when not ({_SELECTED}) then para_idx end ignore nulls) over (partition by doc_id order by para_idx) target from {_HEADINGS})
        select doc_id, target para_idx, min_by(clause_number, para_idx) clause_number, string_agg(case when {_SELECTED} then chr(10) || chr(10) || clause_number || ' ' || clause_text else clause_text end, '' order by para_idx) text
        from t where target is not null group by doc_id, target""",
    "c12_align": f"""
        with e as (select *, row_number() over (partition by doc_id, t order by el_idx) nth from {_EL}),
        p as (select *, row_number() over (partition by doc_id, p order by para_idx) nth from {_PT} where p <> ''),
        f as (select doc_id, p, min(para_idx) first from p group by doc_id, p),
        x as (select e.doc_id, el_idx, t, coalesce(p.para_idx, first) exact from e left join p on p.doc_id = e.doc_id and p.p = t and p.nth = e.nth left join f on f.doc_id = e.doc_id and f.p = t),
        n as (select x.doc_id, el_idx, min(para_idx) near from x join p on p.doc_id = x.doc_id and exact is null and t <> '' and abs(length(t) - length(p)) <= 0.5 * length(t)
              and substr(t, 1, least(100, length(t), length(p))) = substr(p, 1, least(100, length(t), length(p))) group by 1, 2)
        select x.doc_id, x.el_idx, coalesce(exact, near, -1) para_idx from x left join n on n.doc_id = x.doc_id and n.el_idx = x.el_idx""",
    "c13_best_element": f"""
        with s as (select h.doc_id, h.para_idx, clause_number, el_idx, t,
          case when t = p then 1000.0::double when contains(t, p) or contains(p, t) then least(length(t), length(p))::double / greatest(length(t), length(p)) * 500
            when substr(t, 1, least(200, length(t), length(p))) = substr(p, 1, least(200, length(t), length(p))) then least(200, length(t), length(p))::double else 0::double end
          + case when starts_with(t, clause_number) then 500 when contains(t, clause_number) then 200 else 0 end score
          from {_HEADINGS} h join {_PT} p on p.doc_id = h.doc_id and p.para_idx = h.para_idx and p <> '' join {_EL} e on e.doc_id = h.doc_id and t <> ''),
        b as (select *, row_number() over (partition by doc_id, para_idx order by score desc, el_idx) nth from s where score > 0)
        select doc_id, para_idx, clause_number, el_idx, round(score, 4) score from b where nth = 1 and (score > 20 or contains(t, clause_number))""",
    "c14_export": f"select clause_number, text clause_text, notes, exceptions, warnings, jurisdiction from {_CLAUSES}",
    "c15_preview": f"select idx, clause_number, clause_text, greatest((select count(*) from part) - 3, 0) n_more from {X.SHEET_SQL} order by idx limit 3",
    "c16_large_documents": f"select doc_id, count(*) n_paragraphs, cast(sum(strlen(text)) as bigint) n_bytes, count(*) > 20 or sum(strlen(text)) > 8000 is_large from {_P} group by doc_id",
    "c17_subclauses": f"select doc_id, para_idx, regexp_extract(text, '^\\s*\\(([a-z]|[ivx]+)\\)\\s+', 1) item from (select doc_id, para_idx, {_ITEMS} from {_P}) where regexp_matches(text, '^\\s*\\(([a-z]|[ivx]+)\\)\\s+')",
    "c18_align_by_map": f"""select e.doc_id, el_idx, coalesce(a.para_idx, b.para_idx) para_idx from {_EL} e left join {_KEYS} a on a.doc_id = e.doc_id and a.key = t
        left join {_KEYS} b on b.doc_id = e.doc_id and length(t) > 50 and b.key = substr(t, 1, 50)
        where t <> '' and (e.doc_id, coalesce(a.para_idx, b.para_idx)) in (select (doc_id, para_idx) from {_HEADINGS})""",
    "c19_align_first_containment": f"select e.doc_id, el_idx, min(para_idx) para_idx from {_EL} e join {_PT} p on p.doc_id = e.doc_id and (t = p or contains(t, substr(p, 1, 50)) or contains(p, substr(t, 1, 50))) group by 1, 2",
    "n01_n07_numbers": f"select idx, bare, single, number, {_NOTE} note, cast(len({_PARTS}) as int) \"level\", {_PARENT} parent, {_APPENDIX} appendix from {_NUM}",
    "n05_n12_clean_clauses": f"select * from {_CLEAN}",
    "n08_clauses_by_standard": f"""select std || ':' || number || case when nth > 1 then '#' || nth else '' end id, number clause_number, case when {_PARENT} <> '' then std || ':' || ({_PARENT}) else '' end parent_id, '[' || idx || ']' source_rows
        from (select *, row_number() over (partition by std, number order by idx) nth from (select *, concat('AS', cast(3000 + idx % 4 as varchar)) std from {_NUM}) where number <> '')""",
    "n13_children": f"select parent_id, id, \"level\" from {_TREE} where parent_id in (select id from {_TREE})",
    "n13_ancestors": f"{_UP} select id, ancestor_id, distance from up",
    "n13_tree": f"""{_UP}, b as (select ancestor_id id, count(*) n from up group by 1), a as (select id, count(*) depth, max_by(ancestor_id, distance) root from up group by 1)
        select c.id, coalesce(a.depth, 0) depth, coalesce(a.root, c.id) root_id, coalesce(b.n, 0) + 1 subtree_size, false circular from c left join a on a.id = c.id left join b on b.id = c.id""",
    "n13_orphans": f"select id, parent_id from {_CLEAN} where parent_id <> '' and parent_id not in (select id from {_CLEAN})",
}
