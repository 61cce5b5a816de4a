"""Ranked search by postings against a full scan, and how many blocks it reads."""

from __future__ import annotations

import random
import re
import time

import pytest

from clausemill.operators import postings as I

DDL = "volume string, ord long, unit_label string, unit_type string, applies_state string, section_code string, applies_to_class string, text string"
WEIGHT = {"PERFORMANCE_REQUIREMENT": 2, "DTS_PROVISION": 1, "VERIFICATION_METHOD": 1}


def rows(n, seed=1):
    r = random.Random(seed)
    words = ["Fire", "exit", "wall", "a_b", "é", "load-bearing", "load"]
    text = lambda: None if r.random() < 0.05 else " ".join(r.choice(words) for _ in range(r.randint(0, 12)))
    return [(f"V{k % 3}", k, f"L{k}", r.choice([*WEIGHT, "OBJECTIVE"]), r.choice(["", "NSW", "VIC"]), r.choice("ABC"), f"Class {k % 10}", text()) for k in range(n)]


def scan(data, terms, state, types, k, section=None, building_class=None):
    out = []
    for volume, ord_, label, kind, where, sec, cls, text in data:
        n = sum(w in terms for w in re.findall(r"[A-Za-z0-9_]+", (text or "").lower()))
        if n and where in ("", state) and kind in types and section in (None, sec) and (building_class or "") in cls:
            out.append((-n, -WEIGHT.get(kind, 0), volume, ord_, label))
    return [(v, o, label, -n, -w) for n, w, v, o, label in sorted(out)[:k]]


@pytest.fixture(scope="module")
def index(spark):
    before, I.BLOCK = I.BLOCK, 16
    yield I.build_postings(spark.createDataFrame(rows(1500), DDL))
    I.BLOCK = before


@pytest.mark.parametrize("terms", [["fire"], ["fire", "exit", "LOAD"], ["a_b", "nowhere"], ["nowhere"], []])
@pytest.mark.parametrize("more", [{}, {"section": "B"}, {"building_class": "7", "section": "A"}])
def test_equals_a_scan(spark, index, terms, more):
    args = ([t.lower() for t in terms], "NSW", ["PERFORMANCE_REQUIREMENT", "OBJECTIVE"], 7)
    got = I.search(spark, index, terms, *args[1:], **more)
    assert [tuple(r) for r in got.collect()] == scan(rows(1500), *args, **more)


def test_it_stops_early_and_fast(spark):
    data = [(f"V{k // 50_000}", k, "L", "PERFORMANCE_REQUIREMENT" if k % 7 == 0 else "DTS_PROVISION", "", "A", "", "fire exit" if k % 1000 else "fire exit fire") for k in range(100_000)]
    index = I.build_postings(spark.createDataFrame(data, DDL))
    run = lambda: I.search_blocks(spark, index, ["fire", "exit"], "NSW", ["PERFORMANCE_REQUIREMENT", "DTS_PROVISION"], 5, None, None)
    found, read = run()
    assert found == scan(data, ["fire", "exit"], "NSW", ["PERFORMANCE_REQUIREMENT", "DTS_PROVISION"], 5)
    assert 0 < read < index.summaries(spark).select("block").distinct().count() / 20
    began = time.time()
    run()
    print(f"\nsearch over 100,000 units: {time.time() - began:.2f} s, {read} blocks")


def test_no_units(spark):
    index = I.build_postings(spark.createDataFrame([("V1", 1, "L", "OBJECTIVE", "", "A", "", None)], DDL))
    assert I.search(spark, index, ["fire"], "", ["OBJECTIVE"]).collect() == []


def test_postings_stay_where_their_units_are(spark, index):
    """All postings of a block are in one file, sorted by term; none are moved to another task."""
    from pyspark.sql import functions as F

    where = index.postings(spark).select("block", F.input_file_name().alias("file")).distinct()
    assert where.groupBy("block").count().where("count > 1").isEmpty()
    files = [r[0] for r in where.select("file").distinct().collect()]
    terms = [[r[0] for r in spark.read.parquet(f).select("term").collect()] for f in files]
    assert len(files) > 1 and all(t == sorted(t) for t in terms)
