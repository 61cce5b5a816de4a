"""Pieces of DuckDB SQL that several oracles share, written apart from the Spark expressions that they check."""

from __future__ import annotations

W = r"[ \t\n\r\f\x0B]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{W}+|{W}+$', '', 'g')"


def collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{W}+', ' ', 'g'), ' ')"


def some(c: str) -> str:
    return f"nullif({c}, '')"


def first_of(c: str, patterns: list[str]) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({c}, '{p}', 1), '')" for p in patterns) + ", '')"


REFS = [r"(?i)\b([A-Z]\d+[A-Z]\d+[a-z])\b", r"(?i)\b([A-Z]\d+[A-Z]\d+)\b", r"(?i)\b([A-Z]\d+\.\d+)\b", r"(?i)\b([A-Z]\d+)\b"]


def clause_ref(c: str) -> str:
    return f"upper({first_of(c, REFS)})"


def bare_ref(c: str) -> str:
    return strip(f"regexp_replace({c}, '(?i)^table\\s+', '')")


def section(c: str) -> str:
    return first_of(bare_ref(c), [r"^([A-Z])\d+[A-Z]\d+[a-zA-Z]?$", r"^([A-Z])\d+\.\d+", r"^([A-Z])\d+$"])


def part(c: str) -> str:
    return first_of(bare_ref(c), [r"^([A-Z]\d+)[A-Z]\d+[a-zA-Z]?$", r"^([A-Z]\d+)\.\d+", r"^([A-Z]\d+)$"])


def last_part(c: str) -> str:
    return first_of(bare_ref(c), [r"^[A-Z]\d+([A-Z]\d+[a-z]?)$", r"[A-Z]\d+([A-Z])$", r"^([A-Z]\d+)$", r"^([A-Z]\d+)\."])


def unit_type(t: str) -> str:
    return f"""case when regexp_matches({t}, '^P\\d+|P\\d+\\.\\d+|P\\d+[A-Z]\\d+') or contains(lower({t}), 'performance requirement') then 'PERFORMANCE_REQUIREMENT'
      when regexp_matches(lower({t}), 'deemed-to-satisfy|deemed to satisfy|dts') or regexp_matches({t}, '^D\\d+|D\\d+\\.\\d+') then 'DTS_PROVISION'
      when contains(lower({t}), 'verification method') or regexp_matches({t}, '^V\\d+|V\\d+\\.\\d+') then 'VERIFICATION_METHOD'
      when contains(lower({t}), 'evidence of suitability') then 'EVIDENCE_OF_SUITABILITY'
      when contains(lower({t}), 'definition') or regexp_matches({t}, '^[A-Z][^—]+—|^[A-Z][^means]+means') then 'DEFINITION' else 'OTHER' end"""


def discipline_map() -> str:
    """The coverage map's disciplines of each volume and code, in first-seen order."""
    from clausemill.sources.fixtures import DIMS_SQL

    return f"""(select volume, code, list_filter(l, lambda x, i: list_position(l, x) = i) disciplines from (select volume, coalesce(part_code, section_code) code, list(discipline order by topic_id, seq, discipline) l
    from {DIMS_SQL['topic']} join {DIMS_SQL['topic_part']} using (topic_id) group by 1, 2))"""
