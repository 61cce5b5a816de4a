"""Literal vectors, invariants, files and streams."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clausemill.functions import text as T
from clausemill.functions import units as U
from clausemill.functions import variations as V
from clausemill.operators import clauses as C
from clausemill.operators import lookups as L
from clausemill.operators import normalize as N
from clausemill.operators import qa as Q
from clausemill.operators import routing as R
from clausemill.plans import units as P
from clausemill.sources import files as S
from clausemill.sources import fixtures as X
from clausemill.streaming.clauses import stream_clauses

SF = "/root/testdata/sf0.001"


def one(spark, value, *functions):
    row = spark.createDataFrame([(value,)], "t string").select(*[f(F.col("t")).alias(f"c{i}") for i, f in enumerate(functions)]).first()
    return tuple(row) if len(functions) > 1 else row[0]


@pytest.mark.parametrize(
    "text, state, label, body",
    [
        ("NSW J7D3(1)  Artificial lighting", "NSW", "J7D3(1)", "Artificial lighting"),
        ("NSW J7D3(2)", "NSW", "J7D3(2)", ""),
        ("NSW JP1  Special provisions", "NSW", "JP1", "Special provisions"),
        ("(1)   In a sole-occupancy unit", "", "", ""),
        ("VIC H4P2  Room heights", "VIC", "H4P2", "Room heights"),
        (None, None, None, ""),
    ],
)
def test_variation_headings(spark, text, state, label, body):
    assert one(spark, text, V.variation_state, V.variation_label, V.variation_body) == (state, label, body)


def test_base_label_and_subclause(spark):
    assert one(spark, "B4P2(2)", V.base_label, V.subclause) == ("B4P2", "(2)")


@pytest.mark.parametrize("raw, fixed", [("4.4,2", "4.4.2"), ("8.3,1.3.3", "8.3.1.3.3"), ("2.4.3.2,2.7.3", "2.4.3.2.2.7.3"), ("Clause  2.1", "2.1"), ("1.2.3,4.5.6,7.8.9", "1.2.3.4.5.6,7.8.9"), ("", "")])
def test_comma_repair(spark, raw, fixed):
    assert one(spark, raw, N.clause_number) == fixed


def test_corruption_note(spark):
    assert one(spark, "1.2.3.4.5.6,7.8.9", N.corruption_note) == "POSSIBLE OCR CLAUSE CORRUPTION: 1.2.3.4.5.6,7.8.9"
    assert one(spark, "2.4.3", N.corruption_note) == ""


@pytest.mark.parametrize("ref, section, part, routed", [("C1F1", "C", "C1", "F1"), ("P2.1", "P", "P2", "P2"), ("A5G1", "A", "A5", "G1"), ("table D2D1", "D", "D2", "D1"), ("H2V1A", "H", "H2", "A"), ("H2V1a", "H", "H2", "V1a"), ("14", "", "", ""), ("P2", "P", "P2", "P2")])
def test_codes(spark, ref, section, part, routed):
    assert one(spark, ref, U.section_code, U.part_code, U.clause_part_code) == (section, part, routed)


def test_heading_text(spark):
    t = "E3P1 Buildings must resist fire spread. The building envelope..."
    assert one(spark, t, lambda c: U.heading_text(c, F.lit("E3P1"))) == "Buildings must resist fire spread."
    assert one(spark, "x" * 90 + " " + "y" * 60, lambda c: U.heading_text(c, F.lit("")), lambda c: U.heading_text(c, F.lit(""), at_word=True)) == ("x" * 90 + " " + "y" * 9, "x" * 90)


@pytest.mark.parametrize("text, kind", [("P2.1 x", "PERFORMANCE_REQUIREMENT"), ("H4P1 must", "OTHER"), ("see dts", "DTS_PROVISION"), ("V1 x", "VERIFICATION_METHOD"), ("evidence of suitability", "EVIDENCE_OF_SUITABILITY"), ("Door — a leaf", "DEFINITION"), ("plain", "OTHER")])
def test_unit_type(spark, text, kind):
    assert one(spark, text, U.unit_type) == kind


def test_whitespace_order(spark):
    assert one(spark, "a  \t b\n\n\n\nc​  d ", T.normalise_whitespace) == "a b\n\nc  d"
    assert one(spark, "fire-\n  resist", T.dehyphenate) == "fireresist"


def test_sanitise_keeps_allowed_tags(spark):
    html = '<div class="a" onclick="x()"><script>1</script><style>p{}</style><font color="red">t</font><td colspan="2">c</td><!-- n --></div>'
    got = one(spark, html, T.sanitise)
    assert "script" not in got and "style" not in got and "font" not in got and "onclick" not in got
    assert 'class="a"' in got and 'colspan="2"' in got and ">t" in got


def test_repair_is_idempotent(spark):
    pages = X.page_html(spark, SF).limit(10)
    once = T.repair(pages)
    again = once.select("text", T.normalise_whitespace(F.col("text")).alias("again"))
    assert again.where("text <> again").count() == 0


def test_segments_tile_documents(spark):
    """Every paragraph after the first heading is in exactly one clause."""
    p = X.clause_paragraphs(spark, SF)
    seg = C.segments(p)
    bounds = C.segment_bounds(p)
    assert seg.where("seg > 0").count() == bounds.select(F.sum(F.col("last_para") - F.col("first_para") + 1)).first()[0]


def test_verdict_is_monotone(spark):
    units = spark.createDataFrame([(f"U{i}", "PERFORMANCE_REQUIREMENT", "" if i == 0 else "t", "r", "b", "") for i in range(3)], "unit_label string, unit_type string, text string, raw_text string, base_unit_label string, notes_quality string")
    assert not Q.acceptance(units, units).first()["passed"]
    assert Q.acceptance(units, units.withColumn("text", F.lit("t"))).first()["passed"]


def test_nulls_and_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, para_idx int, text string")
    assert C.clauses(empty).count() == 0 and C.toggle_marks(C.headings(empty).withColumnRenamed("clause_text", "text"), empty.selectExpr("doc_id", "para_idx", "text mark_text", "text mark_number")).count() == 0
    nulls = spark.createDataFrame([(1, 0, "1.2 Doors"), (1, 1, None), (1, 2, "NOTE: n"), (None, 0, "2.3 Beams")], "doc_id long, para_idx int, text string")
    assert {(r.doc_id, r.clause_number) for r in C.clauses(nulls).collect()} == {(1, "1.2"), (None, "2.3")}


def test_published_columns_and_order(spark):
    content = spark.createDataFrame([(1, 0, "p", "Preamble"), (1, 1, "h2", "H4P2 Room heights. More"), (1, 2, "p", "must be 2400 mm"), (1, 3, "p", "E3D1 applies to Class 2")], "doc_id long, idx int, tag string, text string")
    cells = spark.createDataFrame([(1, 0, 0, 0, "H9V1a Item", "th", 1, 1), (1, 0, 0, 1, "a|b", "th", 2, 1), (1, 0, 1, 0, "post", "td", 1, 1), (1, 0, 1, 1, "3 mm", "td", 1, 1)], "doc_id long, table_idx int, row_idx int, col_idx int, text string, tag string, colspan int, rowspan int")
    volume = U.volume_label(F.lit("vol1"))
    rows = P.paragraph_units(content, volume, cells).unionByName(P.table_units(cells, volume))
    out = P.publish(rows)
    assert out.columns == P.PUBLISHED and len(out.columns) == 73
    got = {r.order_in_parent: r for r in out.collect()}
    assert [got[k].unit_label for k in range(4)] == ["", "H4P2", "E3D1", "H9V1A"]
    assert got[1].text == "H4P2 Room heights. More\n\nmust be 2400 mm" and got[1].title == "Room heights." and got[1].para_end == 2
    assert got[3].text == "| Item | a\\|b |\n| --- | --- | --- |\n| post | 3 mm |" and got[3].anchor_id == "VOL1::H9V1A" and got[3].table_id == "H9V1A"
    assert got[2].applies_to_class == "2" and got[1].contains_must and got[1].constant_value == "2400 mm"


def test_inline_table_placement(spark):
    content = spark.createDataFrame([(1, 0, "p", "H4P2 one"), (1, 2, "p", "E3D1 two")], "doc_id long, idx int, tag string, text string")
    cells = spark.createDataFrame([(1, 0, 0, 0, "post", 1)], "doc_id long, table_idx int, row_idx int, col_idx int, text string, at int")
    assert P.table_placement(content, cells, "inline").first()["seg"] == 1
    assert P.table_placement(content, cells, "appended").first()["seg"] == 2


def test_effective_view(spark):
    rows = [("Vol1", 1, "A1D1", "", "", ""), ("Vol1", 2, "A1D2", "", "", ""), ("Vol1", 3, "NSW A1D1", "NSW", "REPLACE", "A1D1"), ("Vol1", 4, "x", "VIC", "DELETE", "A1D2")]
    units = spark.createDataFrame(rows, "volume string, ord long, unit_label string, applies_state string, variation_action string, affected_unit_label string")
    assert sorted(r.ord for r in L.effective_view(units, "NSW").collect()) == [2, 3]


# ---- files


def test_units_csv_round_trip(spark, tmp_path):
    units = spark.createDataFrame([("A", 'say "hi", now', True), ("B", " pad \nnext", False), ("C", "", True)], "unit_label string, text string, indexable boolean")
    S.write_units_csv(units, str(tmp_path / "u"))
    raw = "".join(p.read_text() for p in sorted((tmp_path / "u").glob("part-*")))
    assert '""' in raw and "true" in raw and '"say ""hi"", now"' in raw
    back = {r.unit_label: r for r in S.read_units_csv(spark, str(tmp_path / "u"), "unit_label string, text string, indexable string").collect()}
    assert back["A"].text == 'say "hi", now' and back["B"].text == " pad  next" and back["C"].text == ""


def test_short_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c\n1,2,3\n4,5\n\n6,7,8\n")
    schema = "a string, b string, c string"
    assert [r.a for r in S.read_units_csv(spark, str(tmp_path / "x.csv"), schema).collect()] == ["1", "6"]
    assert {tuple(r) for r in S.read_units_csv_padded(spark, str(tmp_path / "x.csv"), schema).collect()} == {("1", "2", "3"), ("4", "5", ""), ("6", "7", "8")}


def test_clause_sheet_and_clean_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text('Clause Number,Clause Text,Notes\n"Clause 4.4,2","HEAD\nbody",n\n4.4.2,again,\n,none,\n')
    sheet = S.read_clause_sheet(spark, str(tmp_path / "s.csv")).withColumn("idx", F.expr("case clause_text when 'again' then 1 when 'none' then 2 else 0 end"))
    clean = N.clean_clauses(sheet, "AS1")
    assert {(r.id, r.heading, r.body, r.notes) for r in clean.collect()} == {("AS1:4.4.2", "HEAD", "body", "n"), ("AS1:4.4.2#2", "", "again", "")}
    S.write_clauses_csv(clean.coalesce(1), str(tmp_path / "c"))
    raw = next((tmp_path / "c").glob("part-*")).read_text()
    assert raw.splitlines()[0] == ",".join(N.CLEAN_COLUMNS) and "True" in raw and "False" in raw
    (tmp_path / "e.csv").write_text("Clause Number\n")
    with pytest.raises(ValueError):
        S.read_clause_sheet(spark, str(tmp_path / "e.csv"))


def test_coverage_map(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"volumes": [{"volume": "Vol1", "topics": [{"topic_id": "T", "section_code": "D", "keywords": ["exit"], "exclude_keywords": ["car"], "routes": [{"part_codes": ["D1", "D2"], "disciplines": ["Egress", "Access"]}]}]}]}')
    dims = S.read_coverage_map(spark, str(tmp_path / "m.json"))
    assert {r.code: r.disciplines for r in L.discipline_map(dims["topic"], dims["topic_part"]).collect()} == {"D1": ["Access", "Egress"], "D2": ["Access", "Egress"]} or L.discipline_map(dims["topic"], dims["topic_part"]).count() == 2
    assert dims["topic_keyword"].count() == 2 and dims["topic"].first()["min_keyword_matches"] == 1
    (tmp_path / "none.json").write_text("{}")
    (tmp_path / "empty.json").write_text("")
    for name in ("none.json", "empty.json", "missing.json"):
        assert all(t.count() == 0 for t in S.read_coverage_map(spark, str(tmp_path / name)).values())


def test_coverage_map_rules(spark, tmp_path):
    (tmp_path / "m.json").write_text("""{"volumes": [{"volume": "Vol1", "topics": [{"topic_id": "T", "allowed_unit_types": ["NOTE"], "required_aspects": ["a"],
        "aspect_extractors": [{"aspect": "a", "patterns": ["x", "Y"]}, {"aspect": "b", "patterns": ["z"]}],
        "guardrails": {"disallow_volumes": ["Vol2"], "must_match": ["a"], "disallow_if_only_unit_type": ["NOTE"], "if_missing_must_say": ["SAY THIS"],
          "custom_rules": [{"rule": "r", "if_question_contains": ["every exit"], "must_include_phrase": ["only exits"], "disallow_phrases": ["all exits"]}]}}, {"topic_id": "U"}]}]}""")
    dims = S.read_coverage_map(spark, str(tmp_path / "m.json"))
    assert {tuple(r) for r in dims["aspect"].collect()} == {("T", "a", "x", True, True), ("T", "a", "Y", True, True), ("T", "b", "z", False, False)}
    assert {tuple(r) for r in dims["topic_unit_type"].collect()} == {("T", "NOTE")}
    evidence = spark.createDataFrame([("T", "Vol1", "NOTE"), ("T", "Vol2", "NOTE")], "topic_id string, volume string, unit_type string")
    assert [tuple(r) for r in R.evidence_rules(evidence, dims["guardrail"]).collect()] == [("T", 1, True, "SAY THIS")]
    answers = spark.createDataFrame([(1, "Is every exit so?", "All exits are."), (2, "Other", "")], "qid int, question string, answer string")
    assert [tuple(r) for r in R.phrase_lists(answers, dims["phrase_rule"]).collect()] == [(1, "T", "r", 1, 1)]


def test_answer_phrases(spark, tmp_path):
    (tmp_path / "m.json").write_text("""{"volumes": [{"topics": [{"topic_id": "T", "guardrails": {"must_use_phrases": ["to the extent", "depending on"], "must_not_cite_sections": ["Part 3"]}},
        {"topic_id": "U", "guardrails": {"if_question_mentions": ["method"], "must_explain": ["tools"], "must_state": ["Class 1"]}}]}]}""")
    rules = S.read_coverage_map(spark, str(tmp_path / "m.json"))["answer_rule"]
    answers = spark.createDataFrame([(1, "Which METHOD?", "To the extent of part 3"), (2, "Else", "")], "qid int, question string, answer string")
    routed = spark.createDataFrame([(q, t) for q in (1, 2) for t in ("T", "U")], "qid int, topic_id string")
    got = {tuple(r) for r in R.answer_phrases(answers, routed, rules).collect()}
    assert got == {(1, "T", "must_use_phrases", 1), (1, "T", "must_not_cite_sections", 1), (1, "U", "must_explain", 1), (1, "U", "must_state", 1), (2, "T", "must_use_phrases", 2), (2, "T", "must_not_cite_sections", 0)}


PATTERNS = ["must", "AS [0-9]+", r"Class\s*(1b|2|3)", "a|b", "(fire|exit) door", "x?", "[a-c]+", r"\bRw\b", "minimum.*height", r"\d+\.?\d*\s*mm", r"\p{Lu}+z", "(?:ab){2}", "(", "É", "two-thirds", "2/3", r"H4\.", "(?i)Must", "a{0,3}b+", ""]


def test_patterns_run_only_where_their_literals_are(spark):
    import re

    from clausemill.operators.matching import literals_of

    assert literals_of("must") == (["must"], True) and literals_of("AS [0-9]+") == (["as "], False)
    assert literals_of("(fire|exit) door") == ([" door"], False) and literals_of(r"\d+\.?\d*\s*mm") == (["mm"], False)
    assert literals_of("abc|def") == (["abc", "def"], False) and literals_of("a|b") == ([], False) and literals_of("x?") == ([], False) and literals_of("(") == ([], False)
    texts = ["You MUST see AS 1428", "as 1", "class 2 Fire door", "Class 1b", "12.5 mm", "minimum clear height", "Rw", "rw", "ABAB", "H4.1 and two-thirds", "aabb", "", None, "É é", "Xz"]
    good = [p for p in PATTERNS if p != "("]
    evidence = spark.createDataFrame([("T", "V", i, t) for i, t in enumerate(texts)], "topic_id string, volume string, ord int, text string")
    aspects = spark.createDataFrame([("T", p, p) for p in good], "topic_id string, aspect string, pattern string")
    plain = {(p, i) for p in good if p != r"\p{Lu}+z" for i, t in enumerate(texts) if t is not None and re.search(p, t, 0 if re.search("[A-Z]", re.sub(r"\\.", "", p)) else re.I | re.A)} | {(r"\p{Lu}+z", 14)}
    for limit in (0, 1 << 20):
        assert {(r.aspect, r.ord) for r in R.aspects_found(evidence, aspects, limit).collect()} == plain


def test_qa_csv_keeps_breaks(spark, tmp_path):
    units = spark.createDataFrame([("A", 'say "hi"', ""), ("B", "one\ntwo", "x")], "unit_label string, text string, title string")
    S.write_qa_csv(units.coalesce(1), str(tmp_path / "q"))
    assert next((tmp_path / "q").glob("part-*")).read_text() == 'unit_label,text,title\nA,"say ""hi""",\nB,"one\ntwo",x\n'
    assert {tuple(r) for r in S.read_qa_csv(spark, str(tmp_path / "q")).collect()} == {tuple(r) for r in units.collect()}


def test_sanitise_attributes_and_styles(spark):
    html = '<P Class=k style="text-align: left; color: red; font-style:italic" onclick="f()">a=b > c</P><table border="1" width="2"><td colspan=\'3\' border="1">x<br/></td></table><!DOCTYPE x><3'
    assert one(spark, html, T.sanitise) == '<p class="k" style="text-align:left;font-style:italic">a=b > c</p><table border="1"><td colspan="3">x<br /></td></table><3'


def test_partitioned_table_and_summary(spark, tmp_path):
    units = X.units(spark, SF)
    S.write_unit_table(units, str(tmp_path / "t"))
    one_volume = S.read_unit_table(spark, str(tmp_path / "t"), "Vol1")
    assert one_volume.count() == units.where("volume = 'Vol1'").count()
    assert "PartitionFilters: [isnotnull(volume" in one_volume._jdf.queryExecution().toString()
    S.write_summary(spark.createDataFrame([(5, 2)], "total_rows long, updated_rows long"), str(tmp_path / "s"), "in", "out")
    got = spark.read.json(str(tmp_path / "s")).first()
    assert (got.total_rows, got.input) == (5, "in") and got.timestamp.endswith("Z")


def test_stream_equals_batch(spark, tmp_path):
    docs = X.table(spark, SF, "documents").select("doc_id", "text").limit(30)
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    stream_clauses(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = C.clauses(docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("para_idx", "text")))
    got = spark.read.parquet(str(tmp_path / "out")).select("doc_id", "para_idx", "text")
    assert got.exceptAll(batch.select("doc_id", "para_idx", "text")).count() == 0 and got.count() == batch.count()


def test_few_patterns_run(spark):
    """Of 3,000 pairs of text and pattern, those that are matched by regular expression."""
    texts = spark.range(300).selectExpr("'T' topic_id", "'V' volume", "id ord", "concat('text ', id, case when id % 10 = 0 then ' AS 1428' else '' end, case when id % 30 = 0 then ' must comply' else '' end) text")
    patterns = ["AS [0-9]{4}", "must comply", "shall", "accessible (path|route)", "[0-9]+ *mm", "H4\\.", "minimum.*height", "where access", "Class\\s*(1b|2)", "AS 1428"]
    aspects = spark.createDataFrame([("T", p, p) for p in patterns], "topic_id string, aspect string, pattern string")
    pairs = R.aspect_candidates(texts, aspects)
    assert pairs.where("not is_sure").count() == 2 * 30 and pairs.where("is_sure").count() == 10
    assert R.aspects_found(texts, aspects).count() == 2 * 30 + 10


def test_topics_without_parts_or_types_take_all(spark):
    units = spark.createDataFrame([("V1", "A", "A1", "X", 1), ("V1", "A", "A2", "Y", 2), ("V1", "B", "A1", "X", 3), ("V2", "A", "A1", "X", 4)], "volume string, section_code string, part_code string, unit_type string, ord long").withColumn("unit_label", F.lit("L"))
    topic = spark.createDataFrame([(t, "V1", "A") for t in ("all", "part", "type", "both")], "topic_id string, volume string, section_code string")
    parts = spark.createDataFrame([("part", "A1"), ("part", "A1"), ("both", "A1"), ("both", "A2")], "topic_id string, part_code string")
    types = spark.createDataFrame([("type", "Y"), ("both", "Y"), ("both", "Z")], "topic_id string, unit_type string")
    got = sorted((r.topic_id, r.ord) for r in R.route_units(units, topic, parts, types).collect())
    assert got == [("all", 1), ("all", 2), ("both", 2), ("part", 1), ("type", 2)]


def test_a_range_beyond_int_is_zero(spark):
    assert tuple(spark.createDataFrame([("para_2147483648_to_7",)], "t string").select(*U.paragraph_range(F.col("t"))).first()) == (0, 7)


def test_units_are_counted_before_topics_meet_them(spark):
    units = spark.createDataFrame([("A", f"Vol{1 + i % 3}", "OBJECTIVE") for i in range(90)] + [("B", "Vol1", "DTS_PROVISION")], "section_code string, volume string, unit_type string")
    topic = spark.createDataFrame([(f"T{i}", "AB"[i % 2]) for i in range(40)], "topic_id string, section_code string")
    rules = topic.select("topic_id", F.array(F.lit("Vol2")).alias("disallow_volumes"), F.array(F.lit("OBJECTIVE")).alias("disallow_if_only"), F.lit("SAY").alias("must_say"))
    got = R.section_rules(units, topic, rules)
    assert sorted(map(tuple, got.collect())) == sorted((f"T{i}", 0, False, "") if i % 2 else (f"T{i}", 30, True, "SAY") for i in range(40))
    assert sorted(map(tuple, R.evidence_rules(units.join(topic, "section_code"), rules).collect())) == sorted(map(tuple, got.collect()))


def _topics(spark, n):
    topic = spark.createDataFrame([(f"T{i}", "Vol1", "A") for i in range(n)], "topic_id string, volume string, section_code string")
    # The first has neither codes nor types, the second no codes.
    parts = spark.createDataFrame([(f"T{i}", "A1") for i in range(2, n)], "topic_id string, part_code string")
    types = spark.createDataFrame([(f"T{i}", k) for i in range(1, n) for k in ("OBJECTIVE", "DTS_PROVISION")], "topic_id string, unit_type string")
    aspect = spark.createDataFrame([(f"T{i}", a, p, True) for i in range(n) for a, p in (("standard", "AS [0-9]+"), ("modality", "must"), ("other", "never"))], "topic_id string, aspect string, pattern string, must_match boolean")
    return topic, parts, types, aspect


def test_patterns_meet_units_once_for_all_topics(spark):
    units = spark.createDataFrame([("Vol1", i, f"U{i}", "A", f"A{1 + i % 2}", ["OBJECTIVE", "DTS_PROVISION", "ODD"][i % 3], "must comply with AS 1" if i % 4 else "nothing") for i in range(48)], "volume string, ord long, unit_label string, section_code string, part_code string, unit_type string, text string")
    sizes = []
    for n in (3, 30):
        topic, parts, types, aspect = _topics(spark, n)
        routed = R.route_units(units, topic, parts, types)
        evidence = routed.join(units.select("volume", "ord", "text"), ["volume", "ord"])
        assert routed.where("topic_id = 'T0'").count() == 48 and routed.where("topic_id = 'T1'").count() == 32 and routed.where("topic_id = 'T2'").count() == 16
        assert sorted(map(tuple, R.routed_aspects(units, topic, parts, types, aspect).collect())) == sorted(map(tuple, R.aspects_found(evidence, aspect).collect()))
        assert sorted(map(tuple, R.routed_guardrails(units, topic, parts, types, aspect).collect())) == sorted(map(tuple, R.guardrails(evidence, aspect).collect()))
        sizes.append(R._found_by_key(units, R.topic_keys(topic, parts, types), aspect)[0].count())
    assert sizes[0] == sizes[1]


def test_words_are_ascii(spark):
    assert one(spark, "lang 5 m\u00e9 und", V.constant_value) == "5 m"
    assert one(spark, "\u00e9H4D5 und", U.clause_ref) == "H4D5"
    assert one(spark, "\u00e9shall not", V.requirement_sentences) == "\u00e9shall not"


def test_a_text_that_just_fits_is_cut_if_more_follows(spark):
    at_limit = [(1, 0, "p", "a" * 32_000), (1, 1, "p", "b" * 765)]
    for more in ([], [(1, 2, "p", "c")]):
        content = spark.createDataFrame(at_limit + more, "doc_id long, idx int, tag string, text string")
        text = P.paragraph_units(content, F.lit("Vol1")).first().text
        assert len(text) == 32_767 and text.endswith("..." if more else "bbb")


def test_a_tables_cells_meet_once(spark):
    """Rows, gaps, pipes, texts with breaks, cells of equal place, and the table's reference, against plain Python; without
    a join of cells with cells."""
    from clausemill.operators import tables as T

    made = [
        (1, 1, 0, 0, "H2V1a: Limits"), (1, 1, 0, 1, " a|b "), (1, 1, 1, 1, "H3V1"), (1, 1, 1, 0, None), (1, 1, 2, 0, "x\ny"), (1, 1, 2, 0, "w"),
        (1, 2, 0, 0, None), (1, 2, 0, 1, "only"), (1, 3, 4, 0, None), (1, 3, 4, 1, None), (1, 3, 9, 0, "end"), (2, 1, 0, 5, "E1.2 far"), (2, 1, 3, 0, "C1 low"),
    ]
    cells = spark.createDataFrame(made, "doc_id long, table_idx int, row_idx int, col_idx int, text string").cache()
    df = T.table_texts(cells)
    got = {(r.doc_id, r.table_idx): (r.rendered, r.ref, sorted(r.early)) for r in df.collect()}
    assert got == {
        (1, 1): ("| Limits | a\\|b |\n| --- | --- | --- |\n| H3V1 |\n| w | x\ny |", "H2V1A", ["H2V1A", "H3V1"]),
        (1, 2): ("| only |", None, []),
        (1, 3): ("|  |\n| --- |\n| end |", None, []),
        (2, 1): ("| far |\n| --- |\n| C1 low |", "E1.2", []),
    }
    assert {k: v[0] for k, v in got.items()} == {(r.doc_id, r.table_idx): r.rendered for r in T.pipe_tables(cells).collect()}
    assert "Join" not in T.pipe_tables(cells)._jdf.queryExecution().optimizedPlan().toString()


def test_strip_takes_ascii_white_space_only(spark):
    texts = ["", " \t\n\r\f\x0b", " a b\t", "\x0bé \u00a0", "\u00a0 x", "\x1f y \x1c", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.strip(F.col("t")).alias("s"))
    assert all(r.s == (None if r.t is None else r.t.strip(" \t\n\r\f\x0b")) for r in df.collect())
    # No pattern, which is tried at every character.
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_an_identity_is_judged_by_one_pattern_a_column(spark):
    """Codes and blanks against plain Python; a filter works out what it is given for each mention, so each code is one pattern."""
    refs = ["C1F1", "C1F1a", "P2.1", "H4", "table  C1D2", " Table H12.5x", "C1F1ab", "c1F1", "C12D", "", "NaN", None, "\tH4 ", "AB1"]
    want = [("C", "C1"), ("C", "C1"), ("P", "P2"), ("H", "H4"), ("C", "C1"), ("", ""), ("", ""), ("", ""), ("", ""), ("", ""), ("", ""), ("", ""), ("H", "H4"), ("", "")]
    codes = spark.createDataFrame([(r,) for r in refs], "r string").select(U.section_code(F.col("r")).alias("s"), U.part_code(F.col("r")).alias("p"))
    assert [tuple(r) for r in codes.collect()] == want
    values = ["x", "", " \t", "NaN", "  NaN ", "\tNaN", "NaN x", "nan", "\x0b", None]
    units = spark.createDataFrame([("V1", i, "A1", v, "A", "A1", v or "p") for i, v in enumerate(values)], "volume string, ord long, unit_label string, applies_to_volume string, section_code string, part_code string, path string")
    got = {r.ord for r in Q.identity_samples(units, 20, 20).collect() if r.sample == "complete"}
    assert got == {i for i, v in enumerate(values) if v and v.strip(" \t\n\r\f\x0b") and v.strip(" ") != "NaN"}
    plan = Q.identity_samples(X.units(spark, SF).withColumns({"applies_to_volume": F.col("volume"), "path": F.col("volume"), "section_code": U.section_code(F.col("unit_label")), "part_code": U.part_code(F.col("unit_label"))}))._jdf.queryExecution().optimizedPlan().toString()
    # Two codes in a filter and a list of columns for each of the two samples.
    assert plan.count("regexp_extract(") == 8


def test_a_cut_at_a_word_looks_at_its_end_only(spark):
    texts = ["a" * 20, "a" * 21, "b" * 9 + " " + "c" * 11, "b" * 8 + " " + "c" * 12, "b" * 10 + " " + "c" * 11, " " * 25, "x" * 15 + " y z" + "w" * 9, "é" * 12 + " " + "é" * 12, None]

    def brute(t, limit=20, cut=15, back=6):
        if t is None or len(t) <= limit:
            return t
        head = t[:cut]
        at = head.rfind(" ")
        return (head[:at] if at > cut - back else head) + f"\n\n[Text truncated. Full length: {len(t)} characters]"

    df = spark.createDataFrame([(t,) for t in texts], "t string").select(T.truncate_word(F.col("t"), 20, 15, 6).alias("c"))
    assert [r.c for r in df.collect()] == [brute(t) for t in texts]
    plan = spark.createDataFrame([("a",)], "t string").select(T.truncate_word(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert ", 32268, 400))" in plan and plan.count("reverse(") == plan.count(", 32268, 400))")


def test_patterns_that_are_skipped_would_find_nothing(spark):
    """Random texts by the functions, and by their patterns alone."""
    import random
    import re

    r = random.Random(6)
    words = ["AS 1", "as 2", "AS/NZS 30", "ISO 9", "XAS 4", "Class 2", "class 3", "Class10", "H1D2", "h1d2a", "P2.1", "K9", "9 mm", "A = B2*C", "must", "SHALL.", "mustard", "If", "WHERE x,", "unless", "Except this.", "Does Not Apply", "plumbing", "Drainage", "the wall is", "an exit must be", "ÉTİ", "—", "means", "V2.3", "D4", "P7", "DTS", "_", "\n", "."]
    texts = [None, "", *[r.choice(["", " "]).join(r.choice(words) for _ in range(r.randint(1, 6))) for _ in range(1500)]]
    t = F.col("t")
    got = spark.createDataFrame([(x,) for x in texts], "t string").select("t", U.clause_ref(t).alias("ref"), U.unit_type(t).alias("kind"), V.external_refs(t).alias("external"), V.internal_refs(t, F.lit("H1D2")).alias("internal"), V.requirement_sentences(t).alias("needs"), V.conditions(t).alias("ifs"), V.exceptions(t).alias("excepts"), V.building_classes(t).alias("classes"), V.scope_volume(t).alias("scope"), V.constant_name(t).alias("name"))
    once = lambda p, x, flags=0: list(dict.fromkeys(m.group(1) for m in re.finditer(p, x, flags | re.A)))
    joined = lambda p, x, flags=0: "|".join(m.group(1) for m in re.finditer(p, x, flags | re.A))

    def ref(x):
        found = [m.group(1) for p in U.REFERENCES if (m := re.search(p, x, re.A)) and m.group(1)]
        return found[0].upper() if found else ""

    def kind(x):
        low, has = x.lower(), lambda *ps: any(re.search(p, x, re.A) for p in ps)
        if has(r"^P\d+", r"P\d+\.\d+", r"P\d+[A-Z]\d+") or "performance requirement" in low:
            return "PERFORMANCE_REQUIREMENT"
        if any(w in low for w in ("deemed-to-satisfy", "deemed to satisfy", "dts")) or has(r"^D\d+", r"D\d+\.\d+"):
            return "DTS_PROVISION"
        if "verification method" in low or has(r"^V\d+", r"V\d+\.\d+"):
            return "VERIFICATION_METHOD"
        if "evidence of suitability" in low:
            return "EVIDENCE_OF_SUITABILITY"
        return "DEFINITION" if "definition" in low or has("^[A-Z][^—]+—", "^[A-Z][^means]+means") else "OTHER"

    for row in got.where("t is not null").collect():
        x = row.t
        assert (row.ref, row.kind) == (ref(x), kind(x)), x
        assert row.external == once(r"(?<!\w)(AS/NZS \d+|AS \d+|ISO \d+)", x)
        assert row.internal == [i for i in once(r"(?<!\w)([A-Z]\d+[A-Z]\d+)(?!\w)", x) if i != "H1D2"]
        assert row.needs == "|".join(s for s in re.split(r"(?<=[.!?])\s+", x, flags=re.A) if re.search(r"(?<!\w)(must|shall)(?!\w)", s, re.I | re.A))
        assert row.ifs == joined(r"(?<!\w)((?:if|where|unless)\s[^,.;]*)", x, re.I)
        assert row.excepts == joined(r"(?<!\w)((?:except|does not apply)(?!\w)[^,.;]*)", x, re.I)
        assert row.classes == "|".join(sorted(once(r"(?<!\w)Class\s*(10|[1-9])", x)))
        scopes = {"Vol3": re.search(r"(?<!\w)(plumbing|drainage)(?!\w)", x, re.I | re.A), "Vol2": re.search(r"(?<!\w)Class\s*(10|1)(?!\w)", x, re.A), "Vol1": re.search(r"(?<!\w)Class\s*[2-9](?!\w)", x, re.A)}
        assert row.scope == next((v for v, m in scopes.items() if m), "")
        name = re.search(r"(?<!\w)(?:the|an?)\s+([a-z ]+?)\s+(?:is|must be|shall be)(?!\w)", x, re.I | re.A)
        assert row.name == (name.group(1).lower() if name else "")
    nulls = got.where("t is null").first()
    assert (nulls.ref, nulls.kind, nulls.scope) == ("", "OTHER", "") and all(nulls[c] is None for c in ("external", "internal", "needs", "ifs", "excepts", "classes", "name"))


def test_what_is_not_there_is_not_cast(spark):
    """A cast that fails is an exception within Spark, one for each table of a document."""
    places = [("para_3_to_7", 3, 7), ("table_4", 0, 0), (None, 0, 0), ("para_99999999999_to_2", 0, 2)]
    found = spark.createDataFrame(places, "at string, a int, b int").select("*", *(c.alias(n) for c, n in zip(U.paragraph_range(F.col("at")), ("x", "y"))))
    assert all((r.a, r.b) == (r.x, r.y) for r in found.collect())
    assert "= )" in found._jdf.queryExecution().optimizedPlan().toString()


def test_a_tables_cells_are_gathered_as_one_list(spark):
    from clausemill.operators.tables import table_texts

    cells = spark.createDataFrame([(1, 0, 0, 0, "H2V1a | Limits"), (1, 0, 0, 1, " b "), (1, 0, 1, 0, "k1"), (1, 0, 3, 0, "Z9"), (1, 0, 1, 1, None), (1, 1, 0, 0, "")], "doc_id int, table_idx int, row_idx int, col_idx int, text string")
    texts = table_texts(cells)
    assert [(r.rendered, r.ref, sorted(r.early)) for r in texts.orderBy("table_idx").collect()] == [("| \\| Limits | b |\n| --- | --- | --- |\n| k1 |\n| Z9 |", "H2V1A", ["H2V1A", "K1"]), ("|  |", None, [])]
    assert "min_by" not in texts._jdf.queryExecution().optimizedPlan().toString()
