"""Inputs derived from the driver's tables, each as a Spark DataFrame and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- clause paragraphs

_PARAGRAPH = """case (doc_id + para_idx) % 8
    when 0 then concat(cast(1 + doc_id % 9 as string), '.', cast(1 + para_idx as string), ' ', line)
    when 1 then concat('Table 2.4 ', line)
    when 3 then concat('NOTE: ', line)
    when 4 then concat('E', cast(1 + doc_id % 9 as string), '.', cast(1 + para_idx as string), '(a) ', line)
    when 5 then concat('EXCEPTION: ', line)
    when 7 then case when doc_id % 2 = 0 then concat('WARNING: ', line) else concat('New Zealand only: ', line) end
    else line end"""

PARAGRAPHS_SQL = f"""(select doc_id, para_idx, {_PARAGRAPH} as text from
    (select doc_id, cast(i - 1 as int) para_idx, a[i] line from
      (select doc_id, a, unnest(range(1, len(a) + 1)) i from (select doc_id, string_split(text, chr(10)) a from documents))))"""


def clause_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, para_idx, text): lines of documents with headings, notes and exclusions put in front of them."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("para_idx", "line"))
    return lines.select("doc_id", "para_idx", F.expr(_PARAGRAPH).alias("text"))


# ---- units

_UNIT = """l_orderkey, l_linenumber,
  concat(substr('ABCDEFGH', cast(1 + l_suppkey % 8 as int), 1), cast(1 + l_orderkey % 9 as string),
         substr('PDVOFG', cast(1 + l_linenumber % 6 as int), 1), cast(1 + l_partkey % 9 as string)) unit_label,
  case when l_orderkey % 11 = 0 then 'STATE_VARIATION' else case l_linenumber % 6
    when 0 then 'PERFORMANCE_REQUIREMENT' when 1 then 'DTS_PROVISION' when 2 then 'VERIFICATION_METHOD'
    when 3 then 'OBJECTIVE' when 4 then 'FUNCTIONAL_STATEMENT' else 'GOVERNING_REQUIREMENT' end end unit_type,
  concat('Vol', cast(1 + l_orderkey % 3 as string)) volume,
  case when l_partkey % 7 = 0 then '' else concat('Clause title ', cast(l_partkey as string)) end title,
  case when l_partkey % 5 = 0 then '' when l_orderkey % 11 = 0 then 'Insert subclause (2) after H4D5'
       else concat('A building must comply with AS ', cast(1000 + l_suppkey as string), '. See E3P', cast(1 + l_partkey % 9 as string), '.') end text,
  case when l_partkey % 10 = 0 then '' when l_orderkey % 11 = 0 then 'Insert subclause (2) after H4D5' else 'raw body' end raw_text,
  case when l_orderkey % 11 = 0 then substr('NSWVICQLDTAS', cast(1 + 3 * (l_partkey % 4) as int), 3) else '' end applies_state,
  l_partkey, l_suppkey, l_extendedprice, l_shipdate"""
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"
_UNIT_COLUMNS = "volume, ord, unit_label, unit_type, title, text, raw_text, applies_state"
#: An order's units follow each other; the factor is prime, so that remainders of ord take all values.
_ORD_STEP = 997
_ORDERED = f"select volume, cast(l_orderkey * {_ORD_STEP} + row_number() over (partition by l_orderkey order by {_ORDER}) as bigint) ord, unit_label, unit_type, title, text, raw_text, applies_state from"

UNITS_SQL = f"({_ORDERED} (select {_UNIT} from lineitem))"


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(volume, ord, unit_label, unit_type, title, text, raw_text, applies_state), ordered by ord within a volume.

    ord comes with real input; here the order key and a row's place among the few rows of its order make it."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(*split_columns(_UNIT))
    place = F.row_number().over(_window("l_orderkey", *_ORDER.split(", ")))
    return rows.withColumn("ord", (F.col("l_orderkey") * _ORD_STEP + place).cast("long")).select(*_UNIT_COLUMNS.split(", "))


def _window(key: str, *order: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(*order)


def split_columns(sql: str) -> list[str]:
    """The columns of a select list, cut at commas outside parentheses and quotes."""
    out, depth, at, quoted = [], 0, 0, False
    for i, c in enumerate(sql):
        quoted ^= c == "'"
        depth += 0 if quoted else (c == "(") - (c == ")")
        if c == "," and not depth and not quoted:
            out.append(sql[at:i].strip())
            at = i + 1
    return [*out, sql[at:].strip()]


def editions(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two editions of units (volume, part_code, ord, unit_label, text): in the second some are gone, reworded, renumbered,
    moved to the end of the volume or to the next part, and some are new. The units are made once and written."""
    from clausemill.sources.files import written

    # Both editions and their furthest place come from it.
    old = written(units.selectExpr("volume", "part_code", "ord", "unit_label", "case when ord % 5 = 0 then text else concat(text, ' Item ', cast(ord as string)) end text"))
    far = old.agg(F.coalesce(F.max("ord"), F.lit(0)).alias("far"))
    kept = old.where("ord % 17 <> 0").crossJoin(F.broadcast(far)).selectExpr(
        "volume", "case when ord % 37 = 0 then concat(part_code, 'x') else part_code end part_code", "case when ord % 23 = 0 then ord + far + 1 else ord end ord",
        "case when ord % 29 = 0 then concat(unit_label, 'a') else unit_label end unit_label", "case when ord % 19 = 0 then concat(text, ' (amended)') else text end text",
    )
    new = old.where("ord % 31 = 0").crossJoin(F.broadcast(far)).selectExpr("volume", "part_code", "-ord ord", "concat('N', unit_label) unit_label", "concat('New: ', text) text")
    return old, kept.unionByName(new)


# ---- table cells

#: The tables of a document: so many at every size, as orders number 15 times the rows of ``documents``.
ORDERS_PER_DOC = 15

_CELL = """doc_id, table_idx, cast(row_idx as int) row_idx, col_idx,
  case col_idx when 0 then case when row_idx = 0 and table_idx % 3 = 0
         then concat('H', cast(1 + table_idx % 8 as string), 'V1a Limits') else concat('k', cast(row_idx as string)) end
       when 1 then concat(cast(cast(l_quantity as int) as string), ' mm')
       when 2 then concat('a|b  ', l_returnflag) else '' end as text,
  case when col_idx = 0 then 'th' else 'td' end tag,
  case when row_idx = 0 and col_idx = 3 then 2 else 1 end colspan, 1 rowspan"""
_CELL_ROWS = f"""select l_orderkey // {ORDERS_PER_DOC} doc_id, l_orderkey table_idx, l_quantity, l_returnflag,
    row_number() over (partition by l_orderkey order by {_ORDER}) - 1 row_idx from"""

CELLS_SQL = f"(select {_CELL} from ({_CELL_ROWS} lineitem) t, (select unnest([0, 1, 2, 3]) col_idx) c)"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, table_idx, row_idx, col_idx, text, tag, colspan, rowspan): four cells for each row of a table. Every order
    is a table, and ORDERS_PER_DOC orders that follow each other are a document's."""
    rows = table(spark, sf_dir, "lineitem")
    numbered = rows.withColumn("row_idx", F.row_number().over(_window("l_orderkey", *_ORDER.split(", "))) - 1)
    wide = numbered.selectExpr(f"l_orderkey div {ORDERS_PER_DOC} doc_id", "l_orderkey table_idx", "row_idx", "l_quantity", "l_returnflag", "explode(array(0, 1, 2, 3)) col_idx")
    return wide.selectExpr(*split_columns(_CELL))


# ---- clause sheet

_SHEET = """p_partkey, cast(p_partkey as int) idx, case p_partkey % 6
    when 0 then concat('Clause ', cast(1 + p_partkey % 9 as string), '.', cast(1 + p_partkey % 4 as string), ',2')
    when 1 then concat(cast(1 + p_partkey % 9 as string), '.3,1.3.3')
    when 2 then '1.2.3,4.5.6,7.8.9'
    when 3 then concat('A.', cast(p_partkey % 20 as string))
    when 4 then concat(cast(1 + p_partkey % 9 as string), '.', cast(p_partkey % 5 as string), ' (a)') else '' end clause_number,
  case when p_partkey % 3 = 0 then concat(upper(p_name), chr(10), 'body ', p_type) else concat(p_name, ' must be fixed.') end clause_text,
  case when p_partkey % 4 = 0 then 'see also' else '' end notes,
  case when p_partkey % 5 = 0 then 'except here' else '' end exceptions,
  case when p_partkey % 7 = 0 then 'hot' else '' end warnings,
  case when p_partkey % 9 = 0 then 'NSW' else '' end jurisdiction"""

SHEET_SQL = f"(select {_SHEET} from part)"


def clause_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, idx, clause_number, clause_text, notes, exceptions, warnings, jurisdiction), with damaged numbers."""
    return table(spark, sf_dir, "part").selectExpr(*split_columns(_SHEET))


def tree_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, clause_number, ...) like ``clause_sheet``, numbered by the digits of the part key, so that clauses have parents:
    1.2.3 is under 1.2. Every seventh clause of the second level on is missing."""
    rows = clause_sheet(spark, sf_dir).withColumn("clause_number", F.expr(r"regexp_replace(cast(p_partkey as string), '(\\d)(?!$)', '$1.')"))
    return rows.where("p_partkey < 10 or p_partkey % 7 <> 0")


TREE_SHEET_SQL = f"(select * replace (array_to_string(string_split(cast(p_partkey as varchar), ''), '.') as clause_number) from {SHEET_SQL} where p_partkey < 10 or p_partkey % 7 <> 0)"


# ---- questions

_QUESTION = """qid, concat(case qid % 5 when 0 then 'Does Volume One apply to ' when 1 then 'What is the meaning of '
    when 2 then 'What is the minimum distance for ' when 3 then 'Is an accessible path of travel needed at every exit '
    else 'How is ' end, text) question, concat('Vol', cast(1 + qid % 3 as string)) volume"""

QUESTIONS_SQL = f"""(select {_QUESTION} from (select item_id qid, text from benchmark
    union all select 100000 + conv_id * 100 + turn, text from conversations where role = 'user') x)"""


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, question, volume)."""
    own = table(spark, sf_dir, "benchmark").selectExpr("item_id qid", "text")
    asked = table(spark, sf_dir, "conversations").where("role = 'user'").selectExpr("100000 + conv_id * 100 + turn qid", "text")
    return own.unionByName(asked).selectExpr(*split_columns(_QUESTION))


# ---- pages with a table

_PAGE_TABLE = """replace(html, '</article>', concat('<p>Table 2.', cast(page_id % 9 as string),
  ' Sizes</p><table><tr><th>H2V1a Item</th><th>Min</th></tr><tr><td>post</td><td>', cast(page_id as string),
  ' mm</td></tr></table><p>NOTE: applies to Class 2</p></article>'))"""

PAGES_SQL = f"(select page_id doc_id, {_PAGE_TABLE} html from pages)"


def page_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, html): pages, each with a caption, a table and a note added."""
    return table(spark, sf_dir, "pages").selectExpr("page_id doc_id", f"{_PAGE_TABLE} html")


_NESTED = """replace(html, '</article>', concat('<DIV class="a">lead <blockquote>said <p>one<p>two <b>', cast(page_id as string), '</b></blockquote><ul><li>first<ul><li>deep</li></ul><li>second <div>boxed</div></ul>',
  '<table><tr><td><p>in a cell</p><table><tr><td>inner</td></tr></table></td></tr></table>', case when page_id % 3 = 0 then '</blockquote>' else '' end, case when page_id % 4 = 0 then '' else '</div>' end, '<h2>end</h2></article>'))"""

NESTED_PAGES_SQL = f"(select page_id doc_id, {_NESTED} html from pages)"


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, html): pages with blocks, lists and tables inside each other, some end tags missing and some too many."""
    return table(spark, sf_dir, "pages").selectExpr("page_id doc_id", f"{_NESTED} html")


# ---- coverage map: a topic for each conversation that the user begins

_DISCIPLINES = ["Egress", "Access", "Structure", "Fire", "General"]
_EXTENTS = ["[0-9]+ *mm", "Insert|Omit", "E3P[1-5]", "A building.*[0-9]{4}"]
PHRASES = [("apply", "Volume", "guarantee"), ("minimum", "mm", "about"), ("meaning", "means", "maybe")]


def _pick(values: list[str], by: str) -> str:
    """A value by a remainder, as SQL."""
    return f"case {by} % {len(values)} " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + " end"


_SECTION = "substr('ABCDEFGH', cast(1 + c % 8 as int), 1)"
_PART_CODE = lambda k: f"concat({_SECTION}, cast(1 + (c + {k}) % 9 as string))"
_FIRST_WORDS, _LAST_WORD = "regexp_extract(t, '^([^ ]+ [^ ]+)', 1)", "regexp_extract(t, '([^ ]+)$', 1)"
_TOPIC_ROWS = "(select conv_id c, text t from conversations where turn = 0 and role = 'user')"
#: Of the topics: keywords, routes as (part codes, disciplines), types, patterns by aspect and phrases by kind, as SQL.
_KEYWORDS = [_FIRST_WORDS, _LAST_WORD, "case when c % 5 = 0 then 'Minimum Distance' else '' end"]
_EXCLUDED = ["case when c % 6 = 0 then 'accessible path' else '' end"]
_ROUTES = [([_PART_CODE(0), _PART_CODE(1)], [_pick(_DISCIPLINES, "c")]), ([_PART_CODE(0)], [_pick(_DISCIPLINES, "(c + 2)"), _pick(_DISCIPLINES, "c")])]
_TYPES = [_pick(["DTS_PROVISION", "PERFORMANCE_REQUIREMENT", "GOVERNING_REQUIREMENT"], "c"), _pick(["OBJECTIVE", "STATE_VARIATION"], "c")]
_ASPECTS = {"standard": ["'AS [0-9]+'", "'AS/NZS'"], "modality": ["'must comply'", "'shall'"], "extent": [_pick(_EXTENTS, "c")]}
_REQUIRED, _MUST_MATCH = ["standard", "modality"], ["standard", "extent"]
_ANSWER_KINDS = {"must_use_phrases": ["'Volume One'", _pick(["means", "10 mm"], "c")], "must_state": ["case when c % 2 = 0 then 'Class 1' else '' end"], "must_explain": ["case when c % 3 = 0 then 'about right' else '' end"], "must_not_cite_sections": ["'Part 3'", "case when c % 4 = 0 then 'Volume' else '' end"]}
_MENTIONS = ["case when c % 3 = 1 then 'meaning' else '' end"]
_TRIGGERS, _INCLUDE, _DISALLOW = ["'every exit'", _FIRST_WORDS], ["'Volume One'", "'10 mm'"], ["'maybe'", _pick(["always", "about right"], "c")]


def _array(items: list[str]) -> str:
    return f"filter(array({', '.join(items)}), x -> x <> '')"


def write_coverage_map(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The map as JSON, a line with one topic for each conversation that the user begins."""
    topics = table(spark, sf_dir, "conversations").where("turn = 0 and role = 'user'").selectExpr("conv_id c", "text t")
    routes = ", ".join(f"named_struct('part_codes', {_array(p)}, 'disciplines', {_array(d)})" for p, d in _ROUTES)
    aspects = ", ".join(f"named_struct('aspect', '{a}', 'patterns', {_array(p)})" for a, p in _ASPECTS.items())
    rule = f"named_struct('rule', concat('R', cast(c as string)), 'if_question_contains', {_array(_TRIGGERS)}, 'must_include_phrase', {_array(_INCLUDE)}, 'disallow_phrases', {_array(_DISALLOW)})"
    names = lambda values: "array(" + ", ".join(f"'{v}'" for v in values) + ")"
    kinds = ", ".join(f"'{k}', {_array(v)}" for k, v in _ANSWER_KINDS.items())
    guardrails = f"""named_struct('disallow_volumes', {_array(["concat('Vol', cast(1 + (c + 1) % 3 as string))"])}, 'must_match', {names(_MUST_MATCH)}, 'disallow_if_only_unit_type', {_array(_TYPES[:1])},
        'if_missing_must_say', {_array(["concat('SEE VOLUME ', cast(1 + c % 3 as string))"])}, 'if_question_mentions', {_array(_MENTIONS)}, {kinds}, 'custom_rules', array({rule}))"""
    topic = f"""named_struct('topic_id', concat('C', cast(c as string)), 'section_code', {_SECTION}, 'min_keyword_matches', case when c % 4 = 0 then null else 1 + c % 2 end, 'keywords', {_array(_KEYWORDS)}, 'exclude_keywords', {_array(_EXCLUDED)},
        'routes', array({routes}), 'allowed_unit_types', {_array(_TYPES)}, 'required_aspects', {names(_REQUIRED)}, 'aspect_extractors', array({aspects}), 'guardrails', {guardrails})"""
    topics.selectExpr(f"array(named_struct('volume', concat('Vol', cast(1 + c % 3 as string)), 'topics', array({topic}))) volumes").write.json(path)


_MAPS: dict[tuple[str, str], str] = {}


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables of the coverage map, by name, read from its JSON, which the first call of a session writes; and phrase, a
    short table of its own."""
    from clausemill.sources.files import exists, read_coverage_map, scratch_path

    key = spark.sparkContext.applicationId, sf_dir
    if key not in _MAPS or not exists(spark, _MAPS[key]):
        path = scratch_path(spark)
        write_coverage_map(spark, sf_dir, path)
        _MAPS[key] = path
    phrase = spark.createDataFrame(PHRASES, "if_contains string, must_include string, must_not_include string")
    return read_coverage_map(spark, _MAPS[key], lines=True) | {"phrase": phrase}


def values_sql(rows: list[tuple], columns: str) -> str:
    quote = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower()
    return f"(select * from (values {', '.join('(' + ', '.join(map(quote, r)) + ')' for r in rows)}) v({columns}))"


def _rows(items: list[str], column: str, more: str = "") -> str:
    """A row for each of the items that is not empty."""
    return " union all ".join(f"select concat('C', cast(c as string)) topic_id, {i} {column}{more} from {_TOPIC_ROWS} where {i} <> ''" for i in items)


_list = lambda items: f"list_filter([{', '.join(items)}], lambda x: x <> '')"
DIMS_SQL = {
    "topic": f"(select concat('C', cast(c as string)) topic_id, concat('Vol', cast(1 + c % 3 as string)) volume, {_SECTION} section_code, cast(case when c % 4 = 0 then 1 else 1 + c % 2 end as int) min_keyword_matches from {_TOPIC_ROWS})",
    "topic_part": "(" + " union all ".join(f"select concat('C', cast(c as string)) topic_id, {1000 * r + p} seq, {code} part_code, {d} discipline from {_TOPIC_ROWS}" for r, (codes, ds) in enumerate(_ROUTES) for p, code in enumerate(codes) for d in ds) + ")",
    "topic_keyword": f"({_rows(_KEYWORDS, 'keyword', ", 'include' kind")} union all {_rows(_EXCLUDED, 'keyword', ", 'exclude' kind")})",
    "topic_unit_type": f"({_rows(_TYPES, 'unit_type')})",
    "aspect": "(" + " union all ".join(_rows(p, "pattern", f", '{a}' aspect, {str(a in _REQUIRED).lower()} required, {str(a in _MUST_MATCH).lower()} must_match") for a, p in _ASPECTS.items()) + ")",
    "guardrail": f"(select concat('C', cast(c as string)) topic_id, [concat('Vol', cast(1 + (c + 1) % 3 as string))] disallow_volumes, [{_TYPES[0]}] disallow_if_only, concat('SEE VOLUME ', cast(1 + c % 3 as string)) must_say from {_TOPIC_ROWS})",
    "phrase_rule": f"(select concat('C', cast(c as string)) topic_id, concat('R', cast(c as string)) \"rule\", {_list(_TRIGGERS)} if_question_contains, {_list(_INCLUDE)} must_include, {_list(_DISALLOW)} disallow from {_TOPIC_ROWS})",
    "answer_rule": "(" + " union all ".join(_rows(v, "phrase", f", '{k}' kind, {_list(_MENTIONS)} if_mentions") for k, v in _ANSWER_KINDS.items()) + ")",
    "phrase": values_sql(PHRASES, "if_contains, must_include, must_not_include"),
}
