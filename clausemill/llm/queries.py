"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import substring_dedup, suffix_dedup
from .common import arrow_batches
from .decontaminate import find_items
from .jaccard_join import jaccard_join
from .line_dedup import line_dedup
from .lm_scoring import score_documents
from .minhash_dedup import near_duplicates
from .phrases import mine_phrases
from .quality_rules import quality_rules
from .sentencepiece_codec import round_trip
from .token_output import token_output
from .warc import archive
from .whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    arrow_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80).drop("class_id")


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), end_id=0)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(_table(spark, sf_dir, "pages")).drop("archive", "record_offset")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents")).drop("kept_text")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=100)
    return rows.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.with_digest(substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=50))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(_table(spark, sf_dir, "documents"), min_count=30, max_words=4, top=2000)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), components=16).withColumnRenamed("id", "vec_id")


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_table(spark, sf_dir, "documents"), words=5, percent=80).drop("class_id")


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_token_output": op2_token_output,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_warc": op5_warc,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_phrases": op11_phrases,
    "op12_whitening": op12_whitening,
    "op13_jaccard_join": op13_jaccard_join,
}

_A, _Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES = {
    "op1_minhash_dedup": f"""
        with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_A}', '{_Z}'), '[^\\x20\\x09-\\x0D]+') ws from documents),
        s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) = 1 then [ws[1]]
                else list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i+1]) end) g from w),
        n as (select doc_id, count(*) n from s group by doc_id),
        p as (select a.doc_id a, b.doc_id b, count(*) i from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
        l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 80 * (x.n + y.n - i)),
        e as (select a, b from l union all select b, a from l),
        r(a, c) as (select doc_id, doc_id from documents union select r.a, e.b from r join e on e.a = r.c),
        m as (select a doc_id, min(c) component_id from r group by a)
        select doc_id, coalesce(n, 0) n_shingles, component_id, doc_id = component_id kept from m left join n using (doc_id)""",
    "op5_warc": f"""
        with p as (select page_id, url, encode(coalesce(html, '')) b from pages),
        d as (select *, sha256(b) digest, octet_length(b) n, min(page_id) over (partition by sha256(b)) first from p),
        u as (select *, coalesce(regexp_replace(url, '[\\x00-\\x20\\x7F]', '%20', 'g'), 'urn:page:' || page_id) uri from d),
        k as (select *, regexp_replace(string_split(lower(uri), '#')[1], '^[a-z][a-z0-9+.-]*://', '') rest from u),
        h as (select *, regexp_extract(rest, '^[^/]*') host, substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) path from k),
        i as (select *, array_to_string(list_reverse(string_split(regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':.*$', ''), '^www[.]', ''), '.')), ',') || ')' || path url_key,
          strftime(timestamp '2024-01-01' + to_seconds(page_id), '%Y%m%d%H%M%S') captured from h)
        select page_id, cast(n as bigint) payload_bytes, digest payload_digest,
          case when n >= 100 and first < page_id then 'revisit' else 'response' end record_type,
          case when n >= 100 and first < page_id then first end refers_to,
          url_key, captured, row_number() over (order by url_key, captured, page_id) - 1 capture_no from i""",
    "op6_line_dedup": f"""
        with s as (select doc_id, string_split(coalesce(text, ''), chr(10)) a from documents),
        l as (select doc_id, unnest(a) line, unnest(range(len(a))) pos from s),
        k as (select *, translate(trim(line, {_WS}), '{_A}', '{_Z}') key from l),
        f as (select key from k where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
        select doc_id, count(*) n_lines, count(f.key) n_dropped,
          sha256(coalesce(string_agg(line, chr(10) order by pos) filter (f.key is null), '')) kept_sha256
        from k left join f using (key) group by doc_id""",
    "op7_quality_rules": f"""
        with recursive d as (select doc_id, coalesce(source, '') host, text, coalesce(text, '') t from documents),
        w as (select doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') ws from d),
        g as (select doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] g
              from (select doc_id, ws, unnest(range(1, len(ws) - 1)) i from w)),
        r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) n from g) where n > 1),
        rw as (select doc_id, count(distinct i + o.o) n from r, (values (0), (1), (2)) o(o) group by doc_id),
        l as (select doc_id, host, text, unnest(string_split(t, chr(10))) line, unnest(range(len(string_split(t, chr(10))))) pos from d),
        dl as (select doc_id, sum(c - 1) n from (select doc_id, line, count(*) c from l
               where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id, line) group by doc_id),
        k as (select doc_id, host, text, pos, translate(regexp_replace(trim(line, {_WS}), '[\\x20\\x09-\\x0D]+', ' ', 'g'), '{_A}', '{_Z}') k from l),
        n as (select * from k where k <> ''),
        pl as (select host, k from n group by host, k having count(distinct doc_id) > 10),
        h as (select doc_id, host, k, len(string_split(k, ' ')) words from n join pl using (host, k)),
        m as (select w.doc_id, len(ws) n_words, cast(list_sum(list_transform(ws, lambda x: length(x))) as bigint) wc,
              length(t) - length(translate(t, '#*$%&|<>', '')) n_symbols, coalesce(dl.n, 0) n_dup_lines, coalesce(rw.n, 0) n_repeat_words
              from w left join dl using (doc_id) left join rw using (doc_id)),
        f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from m),
        su as (select doc_id from f join (select doc_id, sum(words) n from h group by doc_id) using (doc_id) where not base_failed and 100 * (n_words - n) < 30 * n_words),
        lw as (select doc_id, list_transform(ws, lambda x: translate(x, '{_A}', '{_Z}')) ws from w semi join su using (doc_id)),
        sh as (select distinct doc_id, array_to_string(ws[i:i+4], ' ') g from (select doc_id, ws, unnest(range(1, len(ws) - 3)) i from lw)),
        sn as (select doc_id, count(*) n from sh group by doc_id),
        pr as (select a.doc_id a, b.doc_id b, count(*) i from sh a join sh b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
        li as (select a, b from pr join sn x on x.doc_id = a join sn y on y.doc_id = b where 100 * i >= 80 * (x.n + y.n - i)),
        ed as (select a, b from li union all select b, a from li),
        re(a, c) as (select doc_id, doc_id from su union select re.a, ed.b from re join ed on ed.a = re.c),
        gr as (select a doc_id, min(c) g from re group by a),
        bad as (select host, k from h left join gr using (doc_id) group by host, k having count(distinct coalesce(g, doc_id)) > 10),
        bp as (select doc_id, sum(words) n from h join bad using (host, k) group by doc_id)
        select doc_id, cast(n_words as bigint) n_words, coalesce(wc, 0) word_chars, cast(n_symbols as bigint) n_symbols, cast(n_dup_lines as bigint) n_dup_lines,
          cast(n_repeat_words as bigint) n_repeat_words, cast(coalesce(bp.n, 0) as bigint) n_boilerplate, base_failed,
          not base_failed and 100 * (n_words - coalesce(bp.n, 0)) >= 30 * n_words kept from f left join bp using (doc_id)""",
    "op9_substring_dedup": """
        with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') ws from documents),
        p as (select doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) h from (select doc_id, ws, unnest(range(1, len(ws) - 48)) i from w)),
        d as (select doc_id, i from (select *, min(doc_id) over (partition by h) first from p) where first < doc_id),
        x as (select doc_id, ws, unnest(range(1, len(ws) + 1)) i from w),
        c as (select x.doc_id, x.i, x.ws[x.i] word, d.i s from x asof left join d on d.doc_id = x.doc_id and d.i <= x.i),
        k as (select doc_id, i, word, s is not null and s > i - 50 gone from c)
        select w.doc_id, cast(len(ws) as bigint) n_words, count(*) filter (gone) n_removed,
          sha256(coalesce(string_agg(word, ' ' order by i) filter (not gone), '')) kept_sha256
        from w left join k using (doc_id) group by w.doc_id, len(ws)""",
    "op11_phrases": f"""
        with t as (select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_A}', '{_Z}'), '[.,;:!?\\x0A-\\x0D]')) piece from documents),
        w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') ws from t),
        g as (select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i+k-1])) p from w, (values (1), (2), (3), (4)) s(k) where len(ws) >= k),
        f as (select lang, k, p, count(*) f from g group by lang, k, p),
        n as (select lang, cast(sum(f) as bigint) n from f where k = 1 group by lang),
        c as (select * from f where k > 1 and f >= 30),
        u as (select lang, k, p, f a, unnest(range(1, k)) j from c),
        x as (select u.*, l.f l, r.f r, 2000000::hugeint * a // (l.f + r.f) score from u join f l on l.lang = u.lang and l.p = u.p[:j] join f r on r.lang = u.lang and r.p = u.p[j+1:]),
        b as (select lang, k, p, a, min(struct_pack(score := score, j := j, l := l, r := r)) m from x group by lang, k, p, a),
        i as (select distinct lang, f, p[s:s+m-1] q from c, (values (2), (3)) z(m), unnest(range(1, k - m + 2)) o(s) where m < k),
        d as (select distinct b.lang, b.p from b join i on i.lang = b.lang and i.q = b.p and 100 * i.f >= 80 * b.a),
        e as (select b.lang, array_to_string(p, ' ') phrase, a, m.l l, m.r r, n, cast(m.score as bigint) score from b join n using (lang) anti join d using (lang, p))
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) "rank", phrase, a, l, r, n, score from e
        qualify "rank" <= 2000""",
    "op13_jaccard_join": f"""
        with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_A}', '{_Z}'), '[^\\x20\\x09-\\x0D]+') ws from documents),
        s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
                else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) end) g from w),
        n as (select doc_id, count(*) n from s group by doc_id),
        p as (select a.doc_id a, b.doc_id b, count(*) i from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
        l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 80 * (x.n + y.n - i)),
        e as (select a, b from l union all select b, a from l),
        r(a, c) as (select doc_id, doc_id from documents union select r.a, e.b from r join e on e.a = r.c),
        m as (select a doc_id, min(c) component_id from r group by a)
        select doc_id, coalesce(n, 0) n_shingles, component_id from m left join n using (doc_id)""",
}
