"""Carried values for expected visits from a table: equal to the slot form, and to a plain loop."""

import random

import pytest

from subjectflow.operators import longitudinal


def _rows(df, *names):
    return sorted([tuple(r) for r in df.select(*names).collect()], key=str)


@pytest.mark.parametrize("chunk", [3, 1024])
def test_thousand_visits_and_a_hot_subject(spark, monkeypatch, chunk):
    monkeypatch.setattr(longitudinal, "_VISITS", chunk)
    chance = random.Random(5)
    visits = sorted(chance.sample(range(0, 5000), 1000))
    rows = [("hot", chance.randint(-5, 5100), chance.choice([None, 1.0, 2.0, 3.0]), i, f"c{i}") for i in range(600)]
    rows += [(f"s{i % 90}", chance.choice([*visits[:40], 2, 4999]), chance.choice([None, 1.5, 2.5]), 1000 + i, f"c{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "u string, AVISITN int, AVAL double, seq int, c string")
    table = spark.createDataFrame([(v, f"Day {v}") for v in visits], "AVISITN int, AVISIT string")
    got = _rows(longitudinal.locf_table(df, ["u"], table, ["seq", "c"], ["seq"]).filter("DTYPE = 'LOCF'"), "u", "AVISITN", "AVISIT", "AVAL", "seq", "c")
    expected = []
    for u in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == u and r[2] is not None], key=lambda r: (r[1], r[3]))
        seen = {r[1] for r in mine}
        for v in visits:
            before = [r for r in mine if r[1] < v]
            if v not in seen and before:
                expected.append((u, v, f"Day {v}", before[-1][2], before[-1][3], before[-1][4]))
    assert got == sorted(expected, key=str)


def test_equals_the_slot_form(spark):
    chance = random.Random(6)
    df = spark.createDataFrame([(f"s{i % 40}", f"p{i % 3}", chance.randint(0, 9), float(i) if i % 7 else None, i) for i in range(300)], "u string, p string, AVISITN int, AVAL double, seq int")
    listed = [(2, "two"), (5, "five"), (8, "eight")]
    slots = longitudinal.locf(df, ["u", "p"], listed, ["seq"], ["seq"])
    table = longitudinal.locf_table(df, ["u", "p"], spark.createDataFrame(listed, "AVISITN int, AVISIT string"), ["seq"], ["seq"])
    names = ("u", "p", "AVISITN", "AVISIT", "AVAL", "seq", "DTYPE")
    assert _rows(table, *names) == _rows(slots, *names)


def test_visits_by_parameter_and_no_visits(spark):
    df = spark.createDataFrame([("s", "a", 1, 5.0, 1), ("s", "b", 1, 6.0, 2), ("s", "c", 1, 7.0, 3)], "u string, p string, AVISITN int, AVAL double, seq int")
    visits = spark.createDataFrame([("a", 1), ("a", 4), ("b", 0), ("b", 3)], "p string, AVISITN int")
    got = longitudinal.locf_table(df, ["u", "p"], visits, ["seq"], ["seq"], visit=None, visit_by=["p"]).filter("DTYPE = 'LOCF'")
    assert _rows(got, "p", "AVISITN", "AVAL") == [("a", 4, 5.0), ("b", 3, 6.0)]
    assert longitudinal.locf_table(df, ["u", "p"], visits.limit(0), ["seq"], ["seq"], visit=None, visit_by=["p"]).count() == 3
