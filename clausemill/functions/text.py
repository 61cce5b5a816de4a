"""Text repair as column expressions, and HTML to paragraphs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space; written out, since engines differ in what \s covers. So do they in what a word is for \b: patterns say
#: (?<!\w) where a word starts and (?!\w) where it ends, which are ASCII.
WS = r"[ \t\n\r\f\x0B]"
CELL_LIMIT = 32_767
WORD_LIMIT = 32_667

# Tags that sanitising keeps.
ALLOWED_TAGS = [
    "p", "h1", "h2", "h3", "h4", "h5", "h6",
    "ul", "ol", "li",
    "table", "thead", "tbody", "tr", "th", "td",
    "strong", "em", "b", "i", "u",
    "br", "span", "div",
    "blockquote",
]


def strip(c: Column) -> Column:
    """White space off both ends."""
    return F.btrim(c, F.lit(" \t\n\r\f\x0b"))


def unless(text: Column, literals: list[str], none: Column | str, found: Column) -> Column:
    """``found``, a pattern's result, which is ``none`` for texts without any of ``literals``: these are looked for first, as
    bytes. A null text is left to the pattern."""
    has = reduce(lambda x, y: x | y, [F.contains(text, F.lit(w)) for w in literals])
    return F.when(~has, none).otherwise(found)


def collapse(c: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, f"{WS}+", " "), r"^ | \z", "")


def raw_text(html: Column) -> Column:
    """S-2: tags become spaces."""
    return collapse(F.regexp_replace(html, "<[^>]+>", " "))


def normalise_whitespace(c: Column) -> Column:
    """P-1: runs of spaces and tabs to one space, three or more newlines to two, zero-width characters out, no-break
    spaces to spaces (after the runs, so they are not merged), ends trimmed."""
    c = F.regexp_replace(c, r"[ \t]{2,}", " ")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    c = F.regexp_replace(c, "[​-‍﻿]", "")
    return strip(F.regexp_replace(c, " ", " "))


def dehyphenate(c: Column) -> Column:
    """P-2: words broken by a hyphen at a line's end are joined."""
    return F.regexp_replace(c, rf"(?i)([a-z])-{WS}*\n{WS}*([a-z])", "$1$2")


#: Attributes that any tag may have, those of some tags, and the style values that may stay.
ANY_ATTRIBUTES = ["class", "id", "style"]
TAG_ATTRIBUTES = {"table": ["border", "cellpadding", "cellspacing"], "td": ["colspan", "rowspan"], "th": ["colspan", "rowspan"]}
ALLOWED_STYLE = r"^(text-align:(left|right|center|justify)|font-weight:(bold|normal)|font-style:(italic|normal))$"


def _style(value: Column) -> Column:
    """The declarations that may stay."""
    tight = F.regexp_replace(F.regexp_replace(value, r"\s*([:;])\s*", "$1"), r"^\s+|\s+$", "")
    return F.array_join(F.filter(F.split(tight, ";"), lambda x: x.rlike(ALLOWED_STYLE)), ";")


def _attribute(tag: Column) -> Callable[[Column], Column]:
    def clean(a: Column) -> Column:
        key = F.lower(F.regexp_extract(a, r"^\s([A-Za-z-]+)", 1))
        value = F.regexp_replace(F.regexp_replace(a, r"^\s[A-Za-z-]+\s*=\s*", ""), "^[\"']|[\"']$", "")
        whole = F.concat(F.lit(" "), key, F.lit('="'), value, F.lit('"'))
        own = reduce(lambda x, y: x | y, [(tag == t) & key.isin(names) for t, names in TAG_ATTRIBUTES.items()], key.isin(ANY_ATTRIBUTES))
        style = _style(value)
        return F.when((key == "style") & (style != ""), F.concat(F.lit(' style="'), style, F.lit('"'))).when(own & (key != "style"), whole).otherwise("")

    return clean


def _piece(p: Column) -> Column:
    tag = F.lower(F.regexp_extract(p, r"^</?([A-Za-z][A-Za-z0-9]*)", 1))
    attributes = F.regexp_extract_all(p, F.lit("\\s[A-Za-z-]+\\s*=\\s*(?:\"[^\"]*\"|'[^']*'|[^\\s>\"']+)"), F.lit(0))
    opened = F.concat(F.lit("<"), tag, F.array_join(F.transform(attributes, _attribute(tag)), ""), F.when(tag == "br", " />").otherwise(">"))
    kept = F.when(F.startswith(p, F.lit("</")), F.concat(F.lit("</"), tag, F.lit(">"))).otherwise(opened)
    return F.when(tag.isin(ALLOWED_TAGS), kept).when((tag != "") | p.rlike("^<[!?]"), "").otherwise(p)


def sanitise(html: Column) -> Column:
    """P-3: scripts, styles and comments go with their content, other tags that are not allowed go without it, and so do
    attributes and style declarations that are not. Text outside tags stays as it is. A flat filter for corpus
    cleaning, not a parser."""
    html = F.regexp_replace(html, r"(?is)<(script|style)(?!\w)[^>]*>.*?</\1\s*>", "")
    html = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    return F.array_join(F.transform(F.regexp_extract_all(html, F.lit(r"<[^>]*>|[^<]+|<"), F.lit(0)), _piece), "")


def remove_empty_paragraphs(html: Column) -> Column:
    """P-4."""
    return F.regexp_replace(html, "(?i)<p[^>]*>[ \\t\\n\\r\\f\\x0B ]*</p>", "")


def html_paragraphs(html: Column) -> Column:
    """P-5: texts of all <p>, then of all headings, then of all <li>; tags inside become spaces, empty ones go."""
    kinds = [r"(?is)<p[^>]*>(.*?)</p>", r"(?is)<h[1-6][^>]*>(.*?)</h[1-6]>", r"(?is)<li[^>]*>(.*?)</li>"]
    found = F.concat(*[F.regexp_extract_all(html, F.lit(k), F.lit(1)) for k in kinds])
    return F.filter(F.transform(found, raw_text), lambda x: x != "")


def fallback_paragraphs(html: Column) -> Column:
    """P-6: tags to newlines, cut at blank lines."""
    parts = F.split(F.regexp_replace(html, "<[^>]+>", "\n"), rf"\n{WS}*\n")
    return F.filter(F.transform(parts, collapse), lambda x: x != "")


def paragraphs_or_fallback(html: Column) -> Column:
    found = html_paragraphs(html)
    return F.when(F.size(found) > 0, found).otherwise(fallback_paragraphs(html))


def raw_paragraphs(html: Column) -> Column:
    """S-3: tags to newlines, cut at newlines, trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(F.regexp_replace(html, "<[^>]+>", "\n"), r"\n+"), strip), lambda x: x != "")


def explode_paragraphs(df: DataFrame, paragraphs: Column, *keys: str) -> DataFrame:
    """(keys, para_idx, text) from an array of paragraphs."""
    return df.select(*keys, F.posexplode(paragraphs).alias("para_idx", "text"))


def repair(df: DataFrame, html: str = "html") -> DataFrame:
    """P-7: sanitise, drop empty paragraphs, take paragraphs, normalise white space; (doc_id, para_idx, text)."""
    clean = remove_empty_paragraphs(sanitise(F.col(html)))
    kept = F.filter(F.transform(paragraphs_or_fallback(clean), normalise_whitespace), lambda x: x != "")
    return explode_paragraphs(df, kept, "doc_id")


def truncate_hard(c: Column, limit: int = CELL_LIMIT) -> Column:
    """P-8: longer texts end in three dots at the limit."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 3), F.lit("..."))).otherwise(c)


def is_truncated(c: Column, limit: int = CELL_LIMIT) -> Column:
    return F.length(c) > limit


def truncate_word(c: Column, limit: int = CELL_LIMIT, cut: int = WORD_LIMIT, back: int = 400) -> Column:
    """P-9: longer texts are cut at ``cut``, at the last space if it is within ``back`` characters, with a notice. Only the
    ``back`` characters before the cut are searched for it."""
    tail = F.substring(c, max(cut - back, 0) + 1, min(cut, back))
    after = F.instr(F.reverse(tail), " ")  # characters from the last space on
    # A space that begins the tail has cut - back characters before it, one too few.
    kept = F.when((after > 0) & (after < back), F.lit(cut) - after).otherwise(F.lit(cut))
    notice = F.concat(F.lit("\n\n[Text truncated. Full length: "), F.length(c).cast("string"), F.lit(" characters]"))
    return F.when(F.length(c) > limit, F.concat(F.substring(c, F.lit(1), kept), notice)).otherwise(c)
