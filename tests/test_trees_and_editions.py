"""Clause trees and editions against plain Python."""

from __future__ import annotations

import itertools
import random

import pytest

from clausemill.operators import editions
from clausemill.operators.editions import edition_changes, longest_increasing
from clausemill.operators.trees import ancestors, tree_measures


def walk(parent, i):
    out, seen = [], {i}
    while parent.get(i) in parent:
        i = parent[i]
        if i in seen:
            return None
        seen.add(i)
        out.append(i)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_trees_with_circles_and_orphans(spark, seed):
    r = random.Random(seed)
    ids = [f"c{k}" for k in range(60)]
    parent = {i: r.choice([*ids[: 1 + k // (1 + seed)], "", "missing", None]) for k, i in enumerate(ids)}
    parent |= {"x": "y", "y": "z", "z": "x", "under": "x", "self": "self"}
    parent |= {f"chain{k}": f"chain{k + 1}" for k in range(37)}
    rows = spark.createDataFrame([*parent.items(), ("c3", parent["c3"])], "id string, parent_id string")
    up = {i: walk(parent, i) for i in parent}
    assert {tuple(x) for x in ancestors(rows).collect()} == {(i, a, d) for i, line in up.items() if line for d, a in enumerate(line, 1)}
    got = {x.id: (x.depth, x.root_id, x.subtree_size, x.circular) for x in tree_measures(rows).collect()}
    size = {i: 1 + sum(i in (line or []) for line in up.values()) for i in parent}
    assert got == {i: (None, None, None, True) if line is None else (len(line), (line or [i])[-1], size[i], False) for i, line in up.items()}
    assert ancestors(rows.limit(0)).collect() == [] and tree_measures(rows.limit(0)).collect() == []


def test_longest_increasing_run():
    r = random.Random(1)
    for _ in range(300):
        values = r.sample(range(20), r.randint(0, 8))
        keep = longest_increasing(values)
        run = [v for v, k in zip(values, keep) if k]
        best = max(len(c) for n in range(len(values) + 1) for c in itertools.combinations(values, n) if list(c) == sorted(c))
        assert run == sorted(run) and len(run) == best


DDL = "volume string, part_code string, ord long, unit_label string, text string"


def changes(spark, a, b):
    return sorted((tuple(x) for x in edition_changes(spark.createDataFrame(a, DDL), spark.createDataFrame(b, DDL)).collect()), key=repr)


def test_kinds_of_change(spark):
    a = [("V1", "A", k, f"A{k}", f"text {k}") for k in range(10)] + [("V1", "A", 20, "A20", "twice"), ("V1", "A", 21, "A21", "twice"), ("V2", "B", 1, "B1", None), ("V1", "A", 30, "A30", "dup"), ("V1", "A", 31, "A31", "dup")]
    b = [("V1", "A", k, f"A{k}", f"text {k}") for k in range(10) if k not in (2, 4, 5, 7)]
    b += [("V1", "A", 40, "A2", "text 2"), ("V1", "A", 4, "A4", "new words"), ("V1", "A", 5, "A5a", "text 5"), ("V1", "C", 50, "C1", "text 7")]
    b += [("V1", "A", 20, "A20", "twice"), ("V1", "A", 21, "A99", "twice"), ("V2", "B", 1, "B1", ""), ("V1", "A", 60, "A60", "all new"), ("V1", "A", 61, "A30", "dup"), ("V1", "A", 62, "A31", "dup")]
    got = changes(spark, a, b)
    by = lambda kind: {(x[2], x[3]) for x in got if x[1] == kind}
    assert by("moved") == {("A2", "A2"), ("A7", "C1")}
    assert by("renumbered") == {("A5", "A5a"), ("A21", "A99")}
    assert by("changed") == {("A4", "A4")}
    assert by("added") == {(None, "A60")} and by("removed") == set()
    assert by("unchanged") == {(f"A{k}", f"A{k}") for k in (0, 1, 3, 6, 8, 9, 20, 30, 31)} | {("B1", "B1")}


def brute(a, b):
    """The rules again, on lists."""
    out, used_a, used_b = [], set(), set()
    texts = lambda side: {}

    def once(side):
        groups = {}
        for v, part, o, label, t in side:
            groups.setdefault((v, t), []).append((o, label, part))
        return {k: x[0] for k, x in groups.items() if len(x) == 1 and k[1]}

    one, two = once(a), once(b)
    anchors = [(v, *one[v, t], *two[v, t]) for v, t in one if (v, t) in two]
    runs = {}
    for x in anchors:
        if x[3] == x[6]:
            runs.setdefault((x[0], x[3]), []).append(x)
    kept = set()
    for group in runs.values():
        group.sort(key=lambda x: x[1])
        kept |= {x for x, k in zip(group, longest_increasing([x[4] for x in group])) if k}
    pair = lambda kind, v, oa, la, ob, lb: (out.append((v, kind, la, lb, oa, ob)), used_a.add((v, oa)), used_b.add((v, ob)))
    for x in anchors:
        v, oa, la, _, ob, lb, _ = x
        pair("moved" if x not in kept else "unchanged" if la == lb else "renumbered", v, oa, la, ob, lb)
    for key, kind in ((lambda x: (x[0], x[3], x[4]), "unchanged"), (lambda x: (x[0], x[3]), "changed"), (lambda x: (x[0], x[4]), "renumbered")):
        left = sorted((x for x in a if (x[0], x[2]) not in used_a and (kind != "renumbered" or x[4])), key=lambda x: x[2])
        right = sorted((x for x in b if (x[0], x[2]) not in used_b and (kind != "renumbered" or x[4])), key=lambda x: x[2])
        queue = {}
        for x in right:
            queue.setdefault(key(x), []).append(x)
        for x in left:
            if queue.get(key(x)):
                y = queue[key(x)].pop(0)
                pair(kind, x[0], x[2], x[3], y[2], y[3])
    out += [(v, "removed", label, None, o, None) for v, _, o, label, _ in a if (v, o) not in used_a]
    out += [(v, "added", None, label, None, o) for v, _, o, label, _ in b if (v, o) not in used_b]
    return sorted(out, key=repr)


def test_random_editions(spark):
    r = random.Random(4)
    a = [(f"V{k % 2}", r.choice("AB"), k, f"L{r.randrange(90)}", f"t{r.randrange(70)}" if k % 9 else "") for k in range(120)]
    b = [(v, r.choice([p, p, p, "A"]), 7 * o + r.choice([0, 0, 0, 200, -150]), r.choice([label, label, "N" + label]), r.choice([t, t, t, "new" + t])) for v, p, o, label, t in a if r.random() < 0.9]
    b = list({(x[0], x[2]): x for x in b}.values())
    assert changes(spark, a, b) == brute(a, b)
    assert changes(spark, a, []) == brute(a, []) and changes(spark, [], b) == brute([], b)


def test_registered_editions(spark):
    from clausemill.registry.units import derived
    from clausemill.sources.fixtures import editions
    from tests.test_queries import DATA

    sides = [[tuple(x) for x in side.select("volume", "part_code", "ord", "unit_label", "text").collect()] for side in editions(derived(spark, DATA))]
    from clausemill import queries

    got = sorted((tuple(x) for x in queries.QUERIES["r10_editions"](spark, DATA).collect()), key=repr)
    assert got == brute(*sides)
    assert {x[1] for x in got} == {"unchanged", "renumbered", "moved", "changed", "removed", "added"}


def test_what_is_paired_is_written_once(spark, monkeypatch):
    """Units whose texts all stand where they stood are read by no step after the first."""
    rows = []

    def counted(df):
        rows.append(df.count())
        return written(df)

    written = editions.written
    monkeypatch.setattr(editions, "written", counted)
    units = spark.createDataFrame([("V", "A", i, f"L{i}", f"text {i}") for i in range(40)], "volume string, part_code string, ord long, unit_label string, text string")
    assert {r.change for r in editions.edition_changes(units, units).collect()} == {"unchanged"}
    assert sum(rows) == 4 * 40
