"""Sources and text repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from clausemill.functions import text as T
from clausemill.operators import normalize as N
from clausemill.sources import files as S
from clausemill.sources import fixtures as X

from .clauses import CLEAN_SQL as _CLEAN
from .sql import collapse, strip

_NOISY = "concat('  ', replace(text, '. ', concat('.', chr(9), ' ', chr(160))), chr(10), chr(10), chr(10), chr(10), ' end ')"
_BROKEN = "replace(text, 'e ', concat('e- ', chr(10)))"
_GAPPED = "replace(html, '</article>', '<p class=\"x\"> </p><p></p></article>')"
#: Attributes, styles, a script and text that looks like an attribute, put into pages.
_STYLED = """concat('<script>x</script><font color="red">a=b > c</font>', replace(replace(replace(html, '<p>', '<p onclick="f()" class="k" style="text-align: left; color:red;font-weight:bold">'), '<table>', '<table border=1 width="9">'), '<td>', '<td colspan=''2'' border="1" style="color:red">'), '<br>')"""
_LONG = "repeat(concat(text, ' '), 30)"


def _docs(spark, sf):
    return X.table(spark, sf, "documents")


_BROKEN_UNITS = "volume, cast(ord as string) ord, unit_label, title, case when ord % 3 = 0 then concat(text, chr(10), '\"q\", z ') else text end text"
_SHORT_LINES = "concat('u', cast(ord as string), ',', unit_label, case when ord % 4 = 0 then '' when ord % 4 = 1 then concat(',', unit_type) else concat(',', unit_type, ',x') end)"


def _broken(s, d):
    return X.units(s, d).selectExpr(*X.split_columns(_BROKEN_UNITS))


def _through(s, frame, write, read):
    """What is read of what was written to a new folder."""
    path = S.scratch_path(s)
    write(frame, path)
    return read(path)


def _short(s, d, read):
    schema = "id string, unit_label string, unit_type string, mark string"
    lines = X.units(s, d).selectExpr(f"{_SHORT_LINES} value")
    # The reader takes the first line of every file for a header.
    headed = lambda df, path: df.write.csv(path, header=True, sep="\t")
    plain = lines.withColumnRenamed("value", "id,unit_label,unit_type,mark")
    return _through(s, plain, headed, lambda path: read(s, path, schema))


QUERIES = {
    "s04_s08_units_csv": lambda s, d: _through(s, _broken(s, d), S.write_units_csv, lambda path: S.read_units_csv(s, path, "volume string, ord string, unit_label string, title string, text string")),
    "s05_padded_csv": lambda s, d: _short(s, d, S.read_units_csv_padded),
    "s06_s09_clause_sheet": lambda s, d: _through(s, N.clean_clauses(X.clause_sheet(s, d), "AS3000"), S.write_clauses_csv, lambda path: S.read_clause_sheet(s, path)).select(*N.CLEAN_COLUMNS),
    "s10_qa_csv": lambda s, d: _through(s, _broken(s, d), S.write_qa_csv, lambda path: S.read_qa_csv(s, path)),
    "s13_unit_table": lambda s, d: _through(s, X.units(s, d), S.write_unit_table, lambda path: S.read_unit_table(s, path, "Vol2")).select("volume", "ord", "unit_label", "text"),
    "s02_raw_text": lambda s, d: X.table(s, d, "pages").select("page_id", T.raw_text(F.col("html")).alias("text")),
    "s03_raw_paragraphs": lambda s, d: T.explode_paragraphs(X.table(s, d, "pages"), T.raw_paragraphs(F.col("html")), "page_id"),
    "p01_normalise_whitespace": lambda s, d: _docs(s, d).select("doc_id", T.normalise_whitespace(F.expr(_NOISY)).alias("text")),
    "p02_dehyphenate": lambda s, d: _docs(s, d).select("doc_id", T.dehyphenate(F.expr(_BROKEN)).alias("text")),
    "p03_sanitise": lambda s, d: X.page_html(s, d).select("doc_id", T.sanitise(F.expr(_STYLED)).alias("html")),
    "p04_empty_paragraphs": lambda s, d: X.page_html(s, d).select("doc_id", T.remove_empty_paragraphs(F.expr(_GAPPED)).alias("html")),
    "p05_html_paragraphs": lambda s, d: T.explode_paragraphs(X.page_html(s, d), T.html_paragraphs(F.col("html")), "doc_id"),
    "p06_fallback_paragraphs": lambda s, d: T.explode_paragraphs(_docs(s, d).withColumn("html", F.replace("text", F.lit(". "), F.lit("<br><br>"))), T.paragraphs_or_fallback(F.col("html")), "doc_id"),
    "p07_repair": lambda s, d: T.repair(X.page_html(s, d)),
    "p08_truncate_hard": lambda s, d: _docs(s, d).select("doc_id", F.md5(T.truncate_hard(F.expr(_LONG))).alias("digest"), F.length(T.truncate_hard(F.expr(_LONG))).alias("n"), T.is_truncated(F.expr(_LONG)).alias("truncated")),
    "p09_truncate_word": lambda s, d: _docs(s, d).select("doc_id", F.md5(T.truncate_word(F.expr(_LONG))).alias("digest"), F.length(T.truncate_word(F.expr(_LONG))).alias("n")),
}

_PARAGRAPHS = r"""list_filter(list_transform(list_concat(list_concat(
    regexp_extract_all(html, '(?is)<p[^>]*>(.*?)</p>', 1), regexp_extract_all(html, '(?is)<h[1-6][^>]*>(.*?)</h[1-6]>', 1)),
    regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1)), lambda x: """ + collapse("regexp_replace(x, '<[^>]+>', ' ', 'g')") + "), lambda x: x <> '')"


def _indexed(select: str, key: str) -> str:
    return f"select {key}, cast(i - 1 as int) para_idx, a[i] text from (select {key}, a, unnest(range(1, len(a) + 1)) i from ({select}))"


_TAG = "lower(regexp_extract(p, '^</?([A-Za-z][A-Za-z0-9]*)', 1))"
_KEY = "lower(regexp_extract(a, '^\\s([A-Za-z-]+)', 1))"
_VALUE = "regexp_replace(regexp_replace(a, '^\\s[A-Za-z-]+\\s*=\\s*', ''), '^[\"'']|[\"'']$', '', 'g')"
_KEPT_STYLE = f"array_to_string(list_filter(string_split(regexp_replace(regexp_replace({_VALUE}, '\\s*([:;])\\s*', '\\1', 'g'), '^\\s+|\\s+$', '', 'g'), ';'), lambda x: x in ('text-align:left', 'text-align:right', 'text-align:center', 'text-align:justify', 'font-weight:bold', 'font-weight:normal', 'font-style:italic', 'font-style:normal')), ';')"
_SANITISED = f"""array_to_string(list_transform(regexp_extract_all(regexp_replace(regexp_replace({{0}}, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '<[^>]*>|[^<]+|<'), lambda p:
    case when {_TAG} in ('p', 'h1', 'h2', 'h3', 'h4', 'h5', 'h6', 'ul', 'ol', 'li', 'table', 'thead', 'tbody', 'tr', 'th', 'td', 'strong', 'em', 'b', 'i', 'u', 'br', 'span', 'div', 'blockquote') then
      case when starts_with(p, '</') then '</' || {_TAG} || '>' else '<' || {_TAG} || coalesce(array_to_string(list_transform(regexp_extract_all(p, '\\s[A-Za-z-]+\\s*=\\s*(?:"[^"]*"|''[^'']*''|[^\\s>"'']+)'), lambda a:
        case when {_KEY} = 'style' then case when {_KEPT_STYLE} <> '' then ' style="' || {_KEPT_STYLE} || '"' else '' end
          when {_KEY} in ('class', 'id') or ({_TAG} = 'table' and {_KEY} in ('border', 'cellpadding', 'cellspacing')) or ({_TAG} in ('td', 'th') and {_KEY} in ('colspan', 'rowspan')) then ' ' || {_KEY} || '="' || {_VALUE} || '"' else '' end), ''), '') || case when {_TAG} = 'br' then ' />' else '>' end end
      when {_TAG} <> '' or regexp_matches(p, '^<[!?]') then '' else p end), '')"""

_CLEANED = f"regexp_replace({_SANITISED.format('html')}, '(?i)<p[^>]*>[ \\t\\n\\r\\f\\x0B' || chr(160) || ']*</p>', '', 'g')"
_WHITE = lambda x: strip(f"replace(regexp_replace(regexp_replace(regexp_replace({x}, '[ \\t]{{2,}}', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '[' || chr(8203) || '-' || chr(8205) || chr(65279) || ']', '', 'g'), chr(160), ' ')")
_FALLBACK = f"""list_filter(list_transform(string_split_regex(regexp_replace(html, '<[^>]+>', chr(10), 'g'), '\\n[ \\t\\n\\r\\f\\x0B]*\\n'), lambda x: {collapse('x')}), lambda x: x <> '')"""

ORACLES = {
    "p07_repair": _indexed(f"""select doc_id, list_filter(list_transform(case when len(ps) > 0 then ps else {_FALLBACK} end, lambda x: {_WHITE('x')}), lambda x: x <> '') a
        from (select doc_id, html, {_PARAGRAPHS} ps from (select doc_id, {_CLEANED} html from {X.PAGES_SQL}))""", "doc_id"),
    "s04_s08_units_csv": f"select * replace (replace(text, chr(10), ' ') as text) from (select {_BROKEN_UNITS} from {X.UNITS_SQL})",
    "s05_padded_csv": f"select 'u' || ord id, unit_label, case when ord % 4 = 0 then '' else unit_type end unit_type, case when ord % 4 in (0, 1) then '' else 'x' end mark from {X.UNITS_SQL}",
    "s06_s09_clause_sheet": f"""select id, clause_number, heading, body, notes, exceptions, cast("level" as varchar) "level", parent_number, parent_id, {', '.join(f"case when {c} then 'True' else 'False' end {c}" for c in ('appendix_flag', 'embeddable', 'is_heading_only', 'had_duplicate_merge'))}, source_rows from {_CLEAN}""",
    "s10_qa_csv": f"select {_BROKEN_UNITS} from {X.UNITS_SQL}",
    "s13_unit_table": f"select volume, ord, unit_label, text from {X.UNITS_SQL} where volume = 'Vol2'",
    "p03_sanitise": f"select doc_id, {_SANITISED.format(_STYLED)} html from {X.PAGES_SQL}",
    "s02_raw_text": f"select page_id, {collapse("regexp_replace(html, '<[^>]+>', ' ', 'g')")} text from pages",
    "s03_raw_paragraphs": _indexed(f"select page_id, list_filter(list_transform(string_split_regex(regexp_replace(html, '<[^>]+>', chr(10), 'g'), '\\n+'), lambda x: {strip('x')}), lambda x: x <> '') a from pages", "page_id"),
    "p01_normalise_whitespace": f"""select doc_id, {strip(f"replace(regexp_replace(regexp_replace(regexp_replace({_NOISY}, '[ \\t]{{2,}}', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '[' || chr(8203) || '-' || chr(8205) || chr(65279) || ']', '', 'g'), chr(160), ' ')")} text from documents""",
    "p02_dehyphenate": f"select doc_id, regexp_replace({_BROKEN}, '(?i)([a-z])-[ \\t\\n\\r\\f\\x0B]*\\n[ \\t\\n\\r\\f\\x0B]*([a-z])', '\\1\\2', 'g') text from documents",
    "p04_empty_paragraphs": f"select doc_id, regexp_replace({_GAPPED}, '(?i)<p[^>]*>[ \\t\\n\\r\\f\\x0B' || chr(160) || ']*</p>', '', 'g') html from {X.PAGES_SQL}",
    "p05_html_paragraphs": _indexed(f"select doc_id, {_PARAGRAPHS} a from {X.PAGES_SQL}", "doc_id"),
    "p06_fallback_paragraphs": _indexed(f"""select doc_id, list_filter(list_transform(string_split_regex(regexp_replace(replace(text, '. ', '<br><br>'), '<[^>]+>', chr(10), 'g'), '\\n[ \\t\\n\\r\\f\\x0B]*\\n'), lambda x: {collapse('x')}), lambda x: x <> '') a from documents""", "doc_id"),
    "p08_truncate_hard": f"select doc_id, md5(t) digest, cast(length(t) as int) n, truncated from (select doc_id, case when length(l) > 32767 then substr(l, 1, 32764) || '...' else l end t, length(l) > 32767 truncated from (select doc_id, {_LONG} l from documents))",
    "p09_truncate_word": f"""select doc_id, md5(t) digest, cast(length(t) as int) n from (select doc_id,
        case when length(l) > 32767 then (case when sp > 0 and 32667 - sp > 32267 then substr(l, 1, 32667 - sp) else h end)
          || chr(10) || chr(10) || '[Text truncated. Full length: ' || length(l) || ' characters]' else l end t
        from (select *, instr(reverse(h), ' ') sp from (select *, substr(l, 1, 32667) h from (select doc_id, {_LONG} l from documents))))""",
}
