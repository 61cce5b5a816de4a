"""Lookups, quality jobs, routing and retrieval over units."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.functions import units as U
from clausemill.functions import variations as V
from clausemill.operators import editions as D
from clausemill.operators import lookups as L
from clausemill.operators import postings as I
from clausemill.operators import qa as Q
from clausemill.operators import routing as R
from clausemill.operators import vectors as E
from clausemill.sources import fixtures as X
from clausemill.sources.files import exists

from .sql import bare_ref, collapse, discipline_map, last_part, part, section
from .units import DERIVED_SQL, derived

_DIM = X.DIMS_SQL
_CORE = ["PERFORMANCE_REQUIREMENT", "DTS_PROVISION", "VERIFICATION_METHOD", "OBJECTIVE", "FUNCTIONAL_STATEMENT"]
_VOLUMES = ["Vol1", "Vol2", "Vol3"]


def _mapping(s, d):
    dims = X.dims(s, d)
    return L.discipline_map(dims["topic"], dims["topic_part"])


def _ready(s, d) -> DataFrame:
    """Units before repair: raw columns of the quality jobs."""
    return derived(s, d)


def _fixed(s, d) -> DataFrame:
    return Q.apply_fixes(derived(s, d))


def _rich(s, d) -> DataFrame:
    rows = derived(s, d)
    rows = rows.withColumn("text", F.col("marked"))
    return rows.withColumns({"rag_text": F.expr("case when ord % 50 = 0 then '' else text end"), "internal_refs": F.regexp_extract_all("text", F.lit(r"(?<!\w)([A-Z]\d+[A-Z]\d+)(?!\w)"), F.lit(1))})


def _routed(operator, s, d) -> DataFrame:
    """An operator of units, the topics with their routes, and their patterns."""
    dims = X.dims(s, d)
    return operator(derived(s, d), dims["topic"], dims["topic_part"], dims["topic_unit_type"], dims["aspect"])


def _answers(s, d) -> DataFrame:
    return X.questions(s, d).select("qid", "question", F.expr("case qid % 3 when 0 then 'Volume One means 10 mm' when 1 then 'maybe about right' else '' end").alias("answer"))


def _classified(s, d):
    kind, sure, rule = R.classify(F.col("question"))
    return X.questions(s, d).select("qid", kind.alias("query_type"), sure.alias("confidence"), rule.alias("matched_rule"))


def _vectors(s, d):
    return X.table(s, d, "embeddings")


#: Indexes by session and input: one serves all searches over it.
_INDEXES: dict[tuple[str, str], I.PostingsIndex] = {}


def _index(s, d) -> I.PostingsIndex:
    """The index of the units, with classes, built by the first search over them."""
    key = s.sparkContext.applicationId, d
    if key not in _INDEXES or not exists(s, _INDEXES[key].path):
        _INDEXES[key] = I.build_postings(derived(s, d).withColumn("applies_to_class", F.expr("concat('Class ', cast(1 + ord % 10 as string))")))
    return _INDEXES[key]


#: Weights of the labels, as of units: mandatory, optional pathway, other.
_LABEL_WEIGHT = "case label when 0 then 2 when 1 then 1 else 0 end"


def _semantic(s, d, **kw):
    rows = _vectors(s, d).selectExpr("*", f"{_LABEL_WEIGHT} weight")
    queries = rows.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query"))
    return E.semantic_search(E.build_index(rows), queries, **kw)


#: Columns of the coverage map's tables, lists in brackets.
_MAP_COLUMNS = {"topic": ["volume", "section_code", "min_keyword_matches"], "topic_part": ["seq", "part_code", "discipline"], "topic_keyword": ["keyword", "kind"], "topic_unit_type": ["unit_type"], "aspect": ["aspect", "pattern", "required", "must_match"],
    "guardrail": ["[disallow_volumes]", "[disallow_if_only]", "must_say"], "phrase_rule": ["rule", "[if_question_contains]", "[must_include]", "[disallow]"], "answer_rule": ["kind", "phrase", "[if_mentions]"]}


def _shown(c: str) -> str:
    return f"array_to_string({c[1:-1]}, ';')" if c[0] == "[" else f'cast("{c}" as varchar)'


def _map_rows(dims: dict[str, DataFrame]) -> DataFrame:
    """All tables of the coverage map as (source, topic_id, value)."""
    shown = lambda c: F.array_join(c[1:-1], ";") if c[0] == "[" else F.col(c).cast("string")
    rows = [dims[t].select(F.lit(t).alias("source"), "topic_id", F.concat_ws("|", *[shown(c) for c in cols]).alias("value")) for t, cols in _MAP_COLUMNS.items()]
    return reduce(DataFrame.unionByName, rows)


def _referenced(s, d) -> DataFrame:
    return derived(s, d).withColumn("external_refs", F.array_join(V.external_refs(F.col("text")), "|"))


#: Some values go astray; clause and introduction types are put in to see which are allowed.
_ODD = {
    "unit_type": "case when ord % 9 = 0 then 'ODD' when ord % 9 = 1 then 'CLAUSE' when ord % 9 = 2 then 'SUBCLAUSE' when ord % 9 = 3 then 'INTRODUCTION' when ord % 9 = 4 then 'FIGURE' when ord % 9 = 5 then 'TABLE_CELL' when ord % 9 = 6 then 'REFERENCED_DOCUMENT' else unit_type end",
    "compliance_weight": "case when ord % 10 = 3 then 'OPTIONAL' else compliance_weight end",
    "ncc_pathway": "case when ord % 11 = 3 then 'FUNCTIONAL' when ord % 11 = 4 then 'functional' else ncc_pathway end",
    "normative_status": "case when ord % 13 = 3 then '' else normative_status end",
    "conditionality": "case when ord % 14 = 3 then 'IF_VERIFICATION_SELECTED' else conditionality end",
    "applies_to_volume": "case when ord % 15 = 3 then 'Vol1' else applies_to_volume end",
    "applies_state": "case when ord % 16 = 3 then 'NZ' else applies_state end",
}

QUERIES = {
    "j01_discipline": lambda s, d: L.with_discipline(derived(s, d).select("volume", "ord", "unit_label"), _mapping(s, d)).select("volume", "ord", "discipline"),
    "j02_part_codes": lambda s, d: derived(s, d).select("volume", "ord", U.clause_part_code(F.col("clause_ref")).alias("clause_part_code"), U.clause_part_code(F.concat("clause_ref", F.lit("a"))).alias("with_suffix")),
    "j03_discipline_map": lambda s, d: _mapping(s, d).select("volume", "code", F.array_join("disciplines", ", ").alias("disciplines")),
    "j04_codes_of_discipline": lambda s, d: L.codes_of_discipline(_mapping(s, d), "Vol1", "Egress"),
    "j09_variation_anchors": lambda s, d: L.variation_anchors(derived(s, d).where("unit_type = 'STATE_VARIATION'").select("volume", "ord", F.col("affected_unit_label").alias("base_unit_label")), derived(s, d)).select("volume", "ord", "base_unit_label", "affects_anchor_id"),
    "j10_overlay": lambda s, d: L.overlay(derived(s, d), "NSW").select("volume", "ord", "unit_label", "applies_state"),
    "j10_effective_view": lambda s, d: L.effective_view(derived(s, d).withColumn("variation_action", F.expr("case when ord % 2 = 0 then 'REPLACE' else variation_action end")), "NSW").select("volume", "ord", "unit_label", "applies_state"),
    "j11_reference_edges": lambda s, d: L.reference_edges(derived(s, d), F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?<!\w)([A-Z]\d+[A-Z]\d+)(?!\w)"), F.lit(1)))),
    "j12_missing_parents": lambda s, d: L.missing_parents(derived(s, d), F.when(F.col("part_code") == "", "").otherwise(F.concat(F.upper("volume"), F.lit("::"), "part_code"))).select("volume", "ord", "parent_anchor_id"),
    "j13_compliance_chain": lambda s, d: L.compliance_chain(derived(s, d)),
    "j14_keyword_hits": lambda s, d: L.keyword_hits(X.questions(s, d), X.dims(s, d)["topic_keyword"]).select("qid", "topic_id", "keyword", "kind"),
    "a01_missingness": lambda s, d: Q.missingness(_ready(s, d)),
    "a02_samples": lambda s, d: Q.samples(_ready(s, d)),
    "a03_worst_types": lambda s, d: Q.worst_types(_ready(s, d)),
    "a04_evidence": lambda s, d: Q.evidence(_ready(s, d)),
    "a05_categories": lambda s, d: Q.categories(_ready(s, d)),
    "a06_core_comparison": lambda s, d: Q.core_comparison(_ready(s, d), _CORE, _VOLUMES),
    "a07_before_after": lambda s, d: Q.before_after(_ready(s, d), _fixed(s, d)),
    "a08_column_emptiness": lambda s, d: Q.column_emptiness(_ready(s, d).select("ord", "unit_label", "title", "text", "raw_text", "applies_state", "table_id", "table_label", "indexable")),
    "a09_q08_identity": lambda s, d: Q.identity_coverage(_ready(s, d)),
    "a10_identity_samples": lambda s, d: Q.identity_samples(_ready(s, d)),
    "a11_marker_totals": lambda s, d: Q.marker_totals(_ready(s, d).withColumn("text", F.col("marked"))),
    "a12_distributions": lambda s, d: Q.distributions(_ready(s, d)),
    "a13_labels_by_type": lambda s, d: Q.labels_by_type(_ready(s, d), chunk=100),
    "a16_discipline_coverage": lambda s, d: L.discipline_coverage(_mapping(s, d)),
    "q01_q02_hypotheses": lambda s, d: Q.hypotheses(_ready(s, d).withColumn("text", F.expr("case when ord % 7 = 0 then '' else text end"))),
    "q01_examples": lambda s, d: Q.hypothesis_rows(_ready(s, d).withColumn("text", F.expr("case when ord % 7 = 0 then '' else text end"))),
    "v05_v06_fixes": lambda s, d: Q.apply_fixes(_ready(s, d).withColumn("text", F.expr("case when ord % 7 = 0 then '' else text end"))).select("volume", "ord", "text", "notes_quality", "f1_fixed", "f2_unresolved"),
    "q03_q06_acceptance": lambda s, d: Q.acceptance(_ready(s, d), _fixed(s, d)),
    "q07_backfill": lambda s, d: Q.backfill_tables(_ready(s, d).withColumns({"section_code": F.lit(""), "part_code": F.expr("case when ord % 4 = 0 then part_code else '' end")})).select("volume", "ord", "section_code", "part_code", "table_id", "table_label", "updated", "cleared"),
    "s11_backfill_summary": lambda s, d: Q.backfill_summary(Q.backfill_tables(_ready(s, d).withColumns({"section_code": F.lit(""), "part_code": F.lit("")}))),
    "q09_duplicate_anchors": lambda s, d: Q.duplicate_anchors(_ready(s, d)),
    "q10_invalid_enums": lambda s, d: Q.invalid_enums(_ready(s, d).selectExpr("*", "case ncc_pathway when 'DTS' then 'IF_DTS_SELECTED' when 'PERFORMANCE' then 'IF_PERFORMANCE_SELECTED' else 'ALWAYS' end conditionality").selectExpr(f"* except ({', '.join(_ODD)})", *[f"{e} {c}" for c, e in _ODD.items()])),
    "q11_quality_flags": lambda s, d: _ready(s, d).withColumn("text", F.col("marked")).select("volume", "ord", Q.quality_flags().alias("flags")),
    "q12_gates": lambda s, d: Q.gates(_rich(s, d)),
    "r01_classify": _classified,
    "r02_topic_routing": lambda s, d: R.route(X.questions(s, d), X.dims(s, d)["topic"], X.dims(s, d)["topic_keyword"]),
    "r03_route_units": lambda s, d: R.route_units(derived(s, d), X.dims(s, d)["topic"], X.dims(s, d)["topic_part"], X.dims(s, d)["topic_unit_type"]),
    "r04_aspects": lambda s, d: _routed(R.routed_aspects, s, d),
    "r05_guardrails": lambda s, d: _routed(R.routed_guardrails, s, d),
    "r06_phrase_rules": lambda s, d: R.phrase_rules(_answers(s, d), X.dims(s, d)["phrase"]),
    "r07_index": lambda s, d: _index(s, d).summaries(s).groupBy("term").agg(F.max("tf").alias("most"), F.max("weight").alias("weight")),
    "r07_postings": lambda s, d: _index(s, d).postings(s).select("term", "volume", "ord", "tf", "weight"),
    "r07_search": lambda s, d: I.search(s, _index(s, d), ["building", "comply"], "NSW", ["PERFORMANCE_REQUIREMENT", "DTS_PROVISION"]),
    "r08_semantic_search": lambda s, d: _semantic(s, d, labels=[0, 1, 2, 3, 4]).drop("weight"),
    "r08_weighted_search": lambda s, d: _semantic(s, d, labels=[0, 1, 3], boost=0.05),
    "r09_published_sql": lambda s, d: derived(s, d).where("unit_type = 'PERFORMANCE_REQUIREMENT' and unit_label like 'H1%' and text like '%AS 10%'").select("volume", "ord", "unit_label", "title"),
    "r09_requirements_of_a_volume": lambda s, d: R.published_query(_referenced(s, d), volume="Vol2", unit_type="PERFORMANCE_REQUIREMENT").select("unit_label", "title", "text"),
    "r09_variations_of_a_state": lambda s, d: R.published_query(_referenced(s, d), state="NSW").select("unit_label", "variation_action", "affected_unit_label", "text"),
    "r09_provisions_of_a_part": lambda s, d: R.published_query(_referenced(s, d), volume="Vol2", label="H2").select("unit_label", "unit_type", "compliance_weight", "title"),
    "r09_units_citing_a_standard": lambda s, d: R.published_query(_referenced(s, d), standard="AS 1001").select("unit_label", "unit_type", "title"),
    "r07_filtered_search": lambda s, d: I.search(s, _index(s, d), ["building", "comply"], "VIC", ["PERFORMANCE_REQUIREMENT", "DTS_PROVISION", "VERIFICATION_METHOD"], section="C", building_class="5"),
    "r07_rare_terms": lambda s, d: I.search(s, _index(s, d), ["1001", "E3P9"], "NSW", ["PERFORMANCE_REQUIREMENT", "OBJECTIVE", "GOVERNING_REQUIREMENT"], k=20),
    "r05_rules": lambda s, d: R.section_rules(derived(s, d), X.dims(s, d)["topic"], X.dims(s, d)["guardrail"]),
    "r06_phrase_lists": lambda s, d: R.phrase_lists(_answers(s, d), X.dims(s, d)["phrase_rule"]),
    "r06_answer_phrases": lambda s, d: R.routed_answer_phrases(_answers(s, d), X.dims(s, d)["topic"], X.dims(s, d)["topic_keyword"], X.dims(s, d)["answer_rule"]),
    "s07_coverage_map": lambda s, d: _map_rows(X.dims(s, d)),
    "r10_state_differences": lambda s, d: R.state_differences(derived(s, d), "NSW", "VIC"),
    "r10_editions": lambda s, d: D.edition_changes(*X.editions(derived(s, d))),
    "r11_embedding_units": lambda s, d: R.embedding_units(derived(s, d)),
}

_D = DERIVED_SQL
_blank = lambda c: f"({collapse(c)} = '')"
_BOTH = f"({_blank('text')} and {_blank('raw_text')})"
_MAP = discipline_map()
_LABELS = r"regexp_extract_all(text, '\b([A-Z]\d+[A-Z]\d+)\b', 1)"
_INSTR = r"'(?i)(Insert|Omit|Substitute|Replace)\s+(subclause|clause)'"
_HOLED = f"(select * replace (case when ord % 7 = 0 then '' else text end as text) from {_D})"
_F1 = f"(unit_type = 'STATE_VARIATION' and {_blank('text')} and not {_blank('raw_text')} and regexp_matches(raw_text, {_INSTR}))"
_F2 = f"(not {_blank('title')} and {_blank('raw_text')} and {_blank('text')})"
_FIX = lambda src: f"""(select * replace (case when f1_fixed then raw_text else {collapse('text')} end as text, array_to_string(list_concat(list_filter(string_split(notes_quality, '|'), lambda x: x <> '' and not (f1_fixed and x = 'MISSING_TEXT')),
    list_concat(case when f1_fixed then ['INSTRUCTION_ONLY_VARIATION'] else [] end, case when f2_unresolved then ['MISSING_TEXT_UNRESOLVED'] else [] end)), '|') as notes_quality)
    from (select *, {_F1} f1_fixed, unit_type in ('FUNCTIONAL_STATEMENT', 'VERIFICATION_METHOD') and {_F2} f2_unresolved from {src}))"""  # noqa: E731
_UNRES = f"({_blank('raw_text')} or contains(notes_quality, 'MISSING_TEXT_UNRESOLVED'))"
_ACC = lambda n: f"""count(*) filter (unit_type in ('PERFORMANCE_REQUIREMENT', 'DTS_PROVISION', 'SPECIFICATION_CLAUSE') and {_blank('text')}) core_{n},
    count(*) filter (unit_type = 'STATE_VARIATION' and {_blank('text')} and not {_UNRES}) variations_{n}, count(*) filter (unit_type = 'STATE_VARIATION' and {_blank('text')} and {_UNRES}) unresolved_{n},
    count(*) filter (unit_type = 'STATE_VARIATION' and {_blank('base_unit_label')} and not contains(notes_quality, 'UNLINKED_VARIATION')) unlinked_{n},
    count(*) filter (unit_type = 'FUNCTIONAL_STATEMENT' and {_blank('text')}) functional_{n}, count(*) filter (unit_type = 'VERIFICATION_METHOD' and {_blank('text')}) verification_{n}"""  # noqa: E731
_has = lambda c: f"(trim({c}) not in ('', 'NaN'))"
_WHOLE = " and ".join(_has(c) for c in ("applies_to_volume", "section_code", "part_code", "path"))
_GOOD = r"(trim(table_id) <> '' and regexp_matches(table_id, '^[A-Z]\d+[A-Z]\d+[a-zA-Z]?$|^[A-Z]\d+\.\d+$'))"
_FILL = lambda src: f"""(select volume, ord, case when g and section_code = '' then {section('table_id')} else section_code end section_code, case when g and part_code = '' then {part('table_id')} else part_code end part_code,
    case when c then '' else table_id end table_id, case when c then '' else table_label end table_label,
    g and ((section_code = '' and {section('table_id')} <> '') or (part_code = '' and {part('table_id')} <> '')) updated, c cleared from (select *, {_GOOD} g, trim(table_id) <> '' and not {_GOOD} c from {src}))"""  # noqa: E731
_KW = f"(select qid, topic_id, keyword, kind from {X.QUESTIONS_SQL} q join {_DIM['topic_keyword']} k on contains(lower(question), lower(keyword)))"
_ROUTED = f"""(select t.topic_id, u.* from {_D} u join {_DIM['topic']} t on t.volume = u.volume and t.section_code = u.section_code
    where u.part_code in (select part_code from {_DIM['topic_part']} p where p.topic_id = t.topic_id) and u.unit_type in (select unit_type from {_DIM['topic_unit_type']} y where y.topic_id = t.topic_id))"""
_ASPECTS = f"(select r.topic_id, volume, ord, aspect from {_ROUTED} r join {_DIM['aspect']} a on a.topic_id = r.topic_id and regexp_matches(text, case when regexp_matches(regexp_replace(pattern, '\\\\.', '', 'g'), '[A-Z]') then pattern else '(?i)' || pattern end))"
_SC = r"'\b(apply|applies|scope|covers|which classes|volume one apply|application of volume|does.*apply|applies to)\b'"
_DF = r"'\b(define|definition|meaning|term|what does.*mean|in ncc.*what does.*mean)\b'"
_NU = r"'\b(table|minimum|maximum|mm\b|m\b|kpa|l/s|sizing|distance|threshold|row|column|\d+\s*(mm|m|kpa|l/s))\b'"
_WORST = f"(select unit_type, count(*) total_rows, count(*) filter ({_BOTH}) empty_both, round(100 * count(*) filter ({_BOTH}) / count(*), 1) rate from {_D} group by 1 having count(*) filter ({_BOTH}) > 0 order by empty_both desc, unit_type limit 5)"
_CAT = f"case when {_BOTH} then 'C' when {_blank('text')} then 'B' else 'UNKNOWN' end"
_COLS = {"ord": "cast(ord as varchar)", "unit_label": "unit_label", "title": "title", "text": "text", "raw_text": "raw_text", "applies_state": "applies_state", "table_id": "table_id", "table_label": "table_label", "indexable": None}
_H = lambda h, cond: f"select '{h}' hypothesis, count(*) filter ({cond}) n, coalesce(array_to_string(list_sort(list(distinct nullif(regexp_extract(unit_label, '^([A-Z]\\d+)', 1), '')) filter ({cond})), ','), '') prefixes, case when count(*) filter ({cond}) > 0 then 'PROVEN' else 'NOT PROVEN' end verdict from {_HOLED}"
_GATES = {
    "empty_rag_text": "ord % 50 = 0 or trim(text) = ''",
    "variation_without_instruction": f"unit_type = 'STATE_VARIATION' and not regexp_matches(text, {_INSTR})",
    "bad_heading": "length(title) > 150",
    "core_without_text": "unit_type in ('PERFORMANCE_REQUIREMENT', 'DTS_PROVISION', 'SPECIFICATION_CLAUSE') and trim(text) = ''",
    "self_reference": f"list_contains({_LABELS}, unit_label)",
    "variation_without_base": "unit_type = 'STATE_VARIATION' and base_unit_label = ''",
    "table_without_grid": "contains(text, '[TABLE]') and not contains(text, '|')",
}
_SEARCH = "len(string_split_regex(lower(text), '\\bbuilding\\b')) - 1 + len(string_split_regex(lower(text), '\\bcomply\\b')) - 1"
_SIDE = lambda st: f"(select volume, unit_label, min(text) t from {_D} where applies_state = '{st}' group by 1, 2)"
_DISC = f"(select volume, code, array_to_string(disciplines, ', ') d from {_MAP})"

_Q10 = f"(select *, case ncc_pathway when 'DTS' then 'IF_DTS_SELECTED' when 'PERFORMANCE' then 'IF_PERFORMANCE_SELECTED' else 'ALWAYS' end conditionality from {_D})"
#: Of the published types those that the query can meet.
_ALLOWED_TYPES = "'GOVERNING_REQUIREMENT', 'OBJECTIVE', 'FUNCTIONAL_STATEMENT', 'PERFORMANCE_REQUIREMENT', 'DTS_PROVISION', 'VERIFICATION_METHOD', 'STATE_VARIATION', 'INTRODUCTION', 'FIGURE', 'TABLE_CELL', 'REFERENCED_DOCUMENT'"
_TERMS = f"""(select volume, ord, unit_label, unit_type, applies_state, term, count(*) n, case unit_type when 'PERFORMANCE_REQUIREMENT' then 2 when 'DTS_PROVISION' then 1 when 'VERIFICATION_METHOD' then 1 else 0 end weight
    from (select *, unnest(regexp_extract_all(lower(text), '[A-Za-z0-9_]+')) term from {_D}) group by all)"""
_TOPICS = f"""(select qid, topic_id, hits, cast(row_number() over (partition by qid order by hits desc, topic_id) as int) topic_rank from (select qid, topic_id, count(*) filter (kind = 'include') hits, count(*) filter (kind = 'exclude') x from {_KW} group by 1, 2)
        join {_DIM['topic']} using (topic_id) where x = 0 and hits >= coalesce(min_keyword_matches, 1))"""
_ANSWERED = f"(select qid, question, case qid % 3 when 0 then 'Volume One means 10 mm' when 1 then 'maybe about right' else '' end answer from {X.QUESTIONS_SQL})"
_NEAREST = """with s as (select q.vec_id qid, v.vec_id, v.label, round(list_dot_product(q.e, v.e) / sqrt(list_dot_product(q.e, q.e) * list_dot_product(v.e, v.e)), 6) score
          from (select vec_id, cast(embedding as double[]) e from embeddings where vec_id % 20 = 0) q, (select vec_id, label, cast(embedding as double[]) e from embeddings) v),
        t as (select *, row_number() over (partition by qid order by score desc, vec_id) nth from s)"""

ORACLES = {
    "j01_discipline": f"""select u.volume, ord, coalesce(a.d, b.d, c.d, '') discipline from {X.UNITS_SQL} u left join {_DISC} a on a.volume = u.volume and a.code = {last_part('unit_label')}
        left join {_DISC} b on b.volume = u.volume and b.code = regexp_extract({bare_ref('unit_label')}, '^([A-Z])', 1) left join {_DISC} c on c.volume = u.volume and c.code = regexp_extract({bare_ref('unit_label')}, '^([A-Z]\\d+)', 1)""",
    "j02_part_codes": f"select volume, ord, {last_part('clause_ref')} clause_part_code, {last_part("(clause_ref || 'a')")} with_suffix from {_D}",
    "j03_discipline_map": f"select volume, code, array_to_string(disciplines, ', ') disciplines from {_MAP}",
    "j04_codes_of_discipline": f"select volume, code from {_MAP} where volume = 'Vol1' and list_contains(disciplines, 'Egress')",
    "j09_variation_anchors": f"""select v.volume, ord, affected_unit_label base_unit_label, a.x affects_anchor_id from {_D} v left join (select volume, unit_label, min(anchor_id) x from {_D} where unit_label <> '' group by 1, 2) a
        on a.volume = v.volume and a.unit_label = v.affected_unit_label where unit_type = 'STATE_VARIATION'""",
    "j10_overlay": f"select volume, ord, unit_label, applies_state from {_D} where applies_state in ('', 'NSW')",
    "j10_effective_view": f"""select volume, ord, unit_label, applies_state from {_D} u where applies_state = 'NSW' or (applies_state = '' and not exists (select 1 from {_D} v where v.applies_state = 'NSW' and v.volume = u.volume
        and v.affected_unit_label = u.unit_label and (v.ord % 2 = 0 or v.variation_action in ('DELETE', 'REPLACE'))))""",
    "j11_reference_edges": f"""select e.volume, ord, e.unit_label, ref, k.unit_label is not null resolved, ref = e.unit_label is_self from (select distinct volume, ord, unit_label, unnest({_LABELS}) ref from {_D}) e
        left join (select distinct volume, unit_label from {_D}) k on k.volume = e.volume and k.unit_label = ref""",
    "j12_missing_parents": f"select volume, ord, upper(volume) || '::' || part_code parent_anchor_id from {_D} where part_code <> '' and upper(volume) || '::' || part_code not in (select anchor_id from {_D})",
    "j13_compliance_chain": f"""select *, objectives > 0 and functionals > 0 and requirements > 0 and solutions > 0 complete from (select volume, part_code, count(*) filter (unit_type = 'OBJECTIVE') objectives, count(*) filter (unit_type = 'FUNCTIONAL_STATEMENT') functionals,
        count(*) filter (unit_type = 'PERFORMANCE_REQUIREMENT') requirements, count(*) filter (unit_type in ('DTS_PROVISION', 'VERIFICATION_METHOD')) solutions,
        coalesce(array_to_string(list_sort(list(distinct unit_label) filter (unit_type = 'PERFORMANCE_REQUIREMENT')), '|'), '') satisfies_pr_ids from {_D} where part_code <> '' group by 1, 2)""",
    "j14_keyword_hits": f"select * from {_KW}",
    "a01_missingness": f"select unit_type, count(*) total_rows, count(*) filter ({_blank('text')}) empty_text, count(*) filter ({_blank('raw_text')}) empty_raw_text, count(*) filter ({_BOTH}) empty_both, count(*) filter ({_BOTH} and not {_blank('title')}) empty_both_with_title from {_D} group by 1",
    "a02_samples": f"""select unit_type, cast(nth as int) nth, unit_label, substr(title, 1, 120) title, case when raw_text = '' then 'EMPTY' else substr(raw_text, 1, 120) end raw_text from
        (select *, row_number() over (partition by unit_type order by volume, ord) nth from {_D} where {_blank('text')}) where nth <= 5""",
    "a03_worst_types": f"select * from {_WORST}",
    "a04_evidence": f"select volume, ord, unit_type, unit_label, {_CAT} category from {_D} where {_blank('text')} and unit_type in (select unit_type from {_WORST}) order by volume, ord limit 20",
    "a05_categories": f"select {_CAT} category, count(*) n from {_D} group by 1",
    "a06_core_comparison": f"select unit_type, {', '.join(f"cast(coalesce(sum(cast({_BOTH} as int)) filter (volume = '{v}'), 0) as bigint) {v}" for v in _VOLUMES)} from {_D} where unit_type in ({', '.join(f"'{c}'" for c in _CORE)}) group by 1",
    "a07_before_after": f"""select *, case when empty_text_before > 0 then round(100 * (empty_text_before - empty_text_after) / empty_text_before, 1) else 0.0 end improvement from
        (select unit_type, count(*) filter ({_blank('text')}) empty_text_before, count(*) filter ({_BOTH}) empty_both_before from {_D} group by 1) join
        (select unit_type, count(*) filter ({_blank('text')}) empty_text_after, count(*) filter ({_BOTH}) empty_both_after from {_FIX(_D)} group by 1) using (unit_type)""",
    "a08_column_emptiness": "select column_name, total, empty_rows, total - empty_rows non_empty_rows, round(100 * empty_rows / total, 2) empty_percent, case when empty_rows = total then '100' when round(100 * empty_rows / total, 2) > 90 then '>90' when round(100 * empty_rows / total, 2) > 50 then '>50' else '<=50' end band from ("
    + " union all ".join(f"select '{c}' column_name, count(*) total, count(*) filter ({f"trim({e}) in ('', '[]', '0')" if e else 'false'}) empty_rows from {_D}" for c, e in _COLS.items())
    + ")",
    "a09_q08_identity": f"""select {', '.join(f'round(100 * count(*) filter ({_has(c)}) / count(*), 1) {c}_percent' for c in ('applies_to_volume', 'section_code', 'part_code', 'path'))}, round(100 * count(*) filter (indexable) / count(*), 1) indexable_percent,
        count(*) filter ({_has('applies_to_volume')}) > 0 and count(*) filter ({_has('section_code')}) > 0 and count(*) filter ({_has('part_code')}) > 0 and count(*) filter (indexable) > 0 passed from {_D}""",
    "a10_identity_samples": f"select * from (select 'complete' sample, volume, ord, unit_label, section_code, part_code from {_D} where {_WHOLE} order by volume, ord limit 5) union all select * from (select 'missing', volume, ord, unit_label, section_code, part_code from {_D} where not ({_WHOLE}) order by volume, ord limit 10)",
    "a11_marker_totals": f"select count(*) filter (n > 0) rows_with_markers, cast(coalesce(sum(n), 0) as bigint) markers from (select len(regexp_extract_all(marked, '\\bNSW\\s+([A-Z]\\d+[A-Z]\\d+)\\((\\d+)\\)')) n from {_D} where contains(warnings, 'STATE_VARIATION_EMBEDDED'))",
    "a12_distributions": " union all ".join(f"select '{n}' dimension, {c} \"value\", count(*) n from {_D} group by 2" for n, c in (("unit_type", "unit_type"), ("weight", "compliance_weight"), ("state", "applies_state"), ("volume", "volume"))),
    "a13_labels_by_type": f"""select volume, unit_type, chunk, string_agg(unit_label, ', ' order by unit_label) labels from (select *, (row_number() over (partition by volume, unit_type order by unit_label) - 1) // 100 chunk
        from (select distinct volume, unit_type, unit_label from {_D})) group by 1, 2, 3""",
    "a16_discipline_coverage": f"select volume, count(distinct code) codes, count(distinct d) disciplines from (select volume, code, unnest(disciplines) d from {_MAP}) group by 1",
    "q01_q02_hypotheses": f"{_H('H1', _F1)} union all {_H('H2', f"unit_type = 'FUNCTIONAL_STATEMENT' and {_F2}")} union all {_H('H3', f"unit_type = 'VERIFICATION_METHOD' and {_F2}")}",
    "q01_examples": f"select volume, ord, unit_label, substr({collapse('raw_text')}, 1, 150) raw_text from {_HOLED} where {_F1} order by volume, ord limit 10",
    "v05_v06_fixes": f"select volume, ord, text, notes_quality, f1_fixed, f2_unresolved from {_FIX(_HOLED)}",
    "q03_q06_acceptance": f"""select *, case when functional_before > 0 then round(100 * (functional_before - functional_after) / functional_before, 1) else 0.0 end functional_improvement,
        case when verification_before > 0 then round(100 * (verification_before - verification_after) / verification_before, 1) else 0.0 end verification_improvement,
        core_after = 0 a_passed, variations_after = 0 b_passed, functional_after <= 0.2 * functional_before c_passed, verification_after <= 0.2 * verification_before d_passed,
        core_after = 0 and variations_after = 0 and functional_after <= 0.2 * functional_before and verification_after <= 0.2 * verification_before passed
        from (select {_ACC('before')} from {_D}), (select {_ACC('after')} from {_FIX(_D)})""",
    "q07_backfill": f"select * from {_FILL(f"(select * replace ('' as section_code, case when ord % 4 = 0 then part_code else '' end as part_code) from {_D})")}",
    "s11_backfill_summary": f"select count(*) total_rows, count(*) filter (updated) updated_rows, count(*) filter (cleared) cleared_rows, count(*) filter (not updated and not cleared) skipped_rows from {_FILL(f"(select * replace ('' as section_code, '' as part_code) from {_D})")}",
    "q09_duplicate_anchors": f"select anchor_id, count(*) n from {_D} where anchor_id <> '' group by 1 having count(*) > 1",
    "q10_invalid_enums": "select column_name, \"value\", count(*) n from (" + " union all ".join(f"select '{c}' column_name, {e} \"value\" from {_Q10}" for c, e in _ODD.items()) + f""")
        where not (case column_name when 'unit_type' then "value" in ({_ALLOWED_TYPES}) when 'compliance_weight' then "value" in ('MANDATORY', 'OPTIONAL_PATHWAY', 'NON_MANDATORY') when 'ncc_pathway' then "value" in ('PERFORMANCE', 'DTS', 'VERIFICATION', 'OBJECTIVE', 'FUNCTIONAL')
          when 'normative_status' then "value" in ('NORMATIVE', 'INFORMATIVE') when 'conditionality' then "value" in ('ALWAYS', 'IF_DTS_SELECTED', 'IF_PERFORMANCE_SELECTED') when 'applies_to_volume' then "value" in ('V1', 'V2', 'V3', '')
          else "value" in ('SA', 'NSW', 'VIC', 'QLD', 'WA', 'TAS', 'ACT', 'NT', '') end) group by 1, 2""",
    "q11_quality_flags": f"""select volume, ord, array_to_string(list_filter([case when trim(marked) = '' then 'MISSING_TEXT' end, case when trim(title) = '' then 'MISSING_TITLE' end,
        case when case regexp_extract(unit_label, '^[A-Z]\\d+([A-Z])\\d+', 1) when 'G' then 'GOVERNING_REQUIREMENT' when 'O' then 'OBJECTIVE' when 'F' then 'FUNCTIONAL_STATEMENT' when 'P' then 'PERFORMANCE_REQUIREMENT' when 'D' then 'DTS_PROVISION' when 'V' then 'VERIFICATION_METHOD' else '' end <> unit_type then 'CONTEXT_INFERRED' end,
        case when unit_type <> 'STATE_VARIATION' and regexp_matches(marked, '\\bNSW\\s+([A-Z]\\d+[A-Z]\\d+)\\((\\d+)\\)') then 'STATE_VARIATION_EMBEDDED' end,
        case when contains(marked, '[TABLE]') and not contains(marked, '| --- |') then 'TABLE_BLOB_ONLY' end], lambda x: x is not null), '|') flags from {_D}""",
    "q12_gates": "select *, failures = 0 passed from (" + " union all ".join(f"select '{g}' gate, count(*) filter ({c}) failures from (select * replace (marked as text) from {_D})" for g, c in _GATES.items()) + ")",
    "r01_classify": f"""select qid, case when s <> '' then 'SCOPE' when f <> '' then 'DEFINITION' when n <> '' then 'TABLE_NUMERIC' else 'TECHNICAL' end query_type, case when s <> '' then 0.9::double when f <> '' then 0.85 when n <> '' then 0.75 else 0.5 end confidence,
        case when s <> '' then 'SCOPE: ' || s when f <> '' then 'DEFINITION: ' || f when n <> '' then 'TABLE_NUMERIC: ' || n else 'TECHNICAL: default' end matched_rule
        from (select qid, regexp_extract(q, {_SC}) s, regexp_extract(q, {_DF}) f, regexp_extract(q, {_NU}) n from (select qid, trim(lower(question), ' ') q from {X.QUESTIONS_SQL}))""",
    "r02_topic_routing": f"select * from {_TOPICS}",
    "r03_route_units": f"select topic_id, volume, ord, unit_label from {_ROUTED}",
    "r04_aspects": f"select * from {_ASPECTS}",
    "r05_guardrails": f"""select topic_id, missing, missing = '' passed, case when missing = '' then '' else 'Not covered by the evidence: ' || missing end message from (select a.topic_id, coalesce(string_agg(aspect, ',' order by aspect) filter (must_match and not exists
        (select 1 from {_ASPECTS} f where f.topic_id = a.topic_id and f.aspect = a.aspect)), '') missing from {_DIM['aspect']} a group by 1)""",
    "r06_phrase_rules": f"""select qid, if_contains, contains(answer, must_include) has_phrase, not contains(answer, must_not_include) clean from
        (select qid, question, case qid % 3 when 0 then 'Volume One means 10 mm' when 1 then 'maybe about right' else '' end answer from {X.QUESTIONS_SQL}) join {_DIM['phrase']} on contains(lower(question), lower(if_contains))""",
    "r07_index": f"select term, cast(max(n) as int) most, max(weight) weight from {_TERMS} group by term",
    "r07_postings": f"select term, volume, ord, cast(n as int) tf, weight from {_TERMS}",
    "r07_rare_terms": f"""select volume, ord, any_value(unit_label) unit_label, cast(sum(n) as int) "rank", any_value(weight) weight from {_TERMS} where term in ('1001', 'e3p9') and applies_state in ('', 'NSW')
        and unit_type in ('PERFORMANCE_REQUIREMENT', 'OBJECTIVE', 'GOVERNING_REQUIREMENT') group by volume, ord order by "rank" desc, weight desc, volume, ord limit 20""",
    "r07_search": f"""select volume, ord, unit_label, cast({_SEARCH} as int) "rank", case unit_type when 'PERFORMANCE_REQUIREMENT' then 2 else 1 end weight from {_D}
        where applies_state in ('', 'NSW') and unit_type in ('PERFORMANCE_REQUIREMENT', 'DTS_PROVISION') and {_SEARCH} > 0 order by "rank" desc, weight desc, volume, ord limit 5""",
    "r08_semantic_search": f"""{_NEAREST}
        select qid, vec_id, score, cast(place as int) place from (select *, row_number() over (partition by qid order by score desc, vec_id) place from t where nth <= 20 and label in (0, 1, 2, 3, 4)) where place <= 5""",
    "r08_weighted_search": f"""{_NEAREST}
        select qid, vec_id, score, weight, cast(place as int) place from (select *, row_number() over (partition by qid order by round(score + 0.05::double * weight, 6) desc, vec_id) place
          from (select *, {_LABEL_WEIGHT} weight from t where nth <= 20 and label in (0, 1, 3))) where place <= 5""",
    "r09_published_sql": f"select volume, ord, unit_label, title from {_D} where unit_type = 'PERFORMANCE_REQUIREMENT' and unit_label like 'H1%' and text like '%AS 10%'",
    "r09_requirements_of_a_volume": f"select unit_label, title, text from {_D} where volume = 'Vol2' and unit_type = 'PERFORMANCE_REQUIREMENT'",
    "r09_variations_of_a_state": f"select unit_label, variation_action, affected_unit_label, text from {_D} where applies_state = 'NSW'",
    "r09_provisions_of_a_part": f"select unit_label, unit_type, compliance_weight, title from {_D} where volume = 'Vol2' and unit_label like 'H2%'",
    "r09_units_citing_a_standard": f"select unit_label, unit_type, title from {_D} where array_to_string(regexp_extract_all(text, '\\b(AS/NZS \\d+|AS \\d+|ISO \\d+)', 1), '|') like '%AS 1001%'",
    "r07_filtered_search": f"""select volume, ord, unit_label, cast({_SEARCH} as int) "rank", case unit_type when 'PERFORMANCE_REQUIREMENT' then 2 else 1 end weight from {_D}
        where applies_state in ('', 'VIC') and unit_type in ('PERFORMANCE_REQUIREMENT', 'DTS_PROVISION', 'VERIFICATION_METHOD') and section_code = 'C' and 1 + ord % 10 = 5 and {_SEARCH} > 0 order by "rank" desc, weight desc, volume, ord limit 5""",
    "r05_rules": f"""select topic_id, count(*) filter (list_contains(disallow_volumes, volume)) disallowed, bool_and(list_contains(disallow_if_only, unit_type)) only_weak_types,
        case when bool_and(list_contains(disallow_if_only, unit_type)) or count(*) filter (list_contains(disallow_volumes, volume)) > 0 then any_value(must_say) else '' end must_say
        from {_D} join (select topic_id, section_code from {_DIM['topic']}) using (section_code) join {_DIM['guardrail']} using (topic_id) group by 1""",
    "r06_phrase_lists": f"""select qid, topic_id, "rule", len(list_filter(must_include, lambda x: not contains(lower(answer), lower(x)))) missing, len(list_filter(disallow, lambda x: contains(lower(answer), lower(x)))) forbidden
        from {_ANSWERED} join {_DIM['phrase_rule']} on len(list_filter(if_question_contains, lambda x: contains(lower(question), lower(x)))) > 0""",
    "r06_answer_phrases": f"""select qid, topic_id, kind, count(*) filter (contains(lower(answer), lower(phrase)) = (kind = 'must_not_cite_sections')) broken from {_ANSWERED} join {_TOPICS} using (qid) join {_DIM['answer_rule']} using (topic_id)
        where len(if_mentions) = 0 or len(list_filter(if_mentions, lambda x: contains(lower(question), lower(x)))) > 0 group by 1, 2, 3""",
    "s07_coverage_map": " union all ".join(f"select '{t}' source, topic_id, concat_ws('|', {', '.join(_shown(c) for c in cols)}) \"value\" from {_DIM[t]}" for t, cols in _MAP_COLUMNS.items()),
    "r10_state_differences": f"select coalesce(a.volume, b.volume) volume, coalesce(a.unit_label, b.unit_label) unit_label, a.t is null only_in_b, b.t is null only_in_a from {_SIDE('NSW')} a full join {_SIDE('VIC')} b on a.volume = b.volume and a.unit_label = b.unit_label where a.t is distinct from b.t",
    "r11_embedding_units": f"""select volume, ord, concat_ws(' ', unit_type, compliance_weight) authority, concat_ws(chr(10), nullif(title, ''), text) evidence,
        cast(to_json({{'volume': volume, 'section_code': section_code, 'part_code': part_code, 'applies_state': applies_state}}) as varchar) metadata from {_D}""",
}
