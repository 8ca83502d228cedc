"""Rules as rows."""

import pytest

from subjectflow.operators import rules


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, 5, "x"), (2, None, "y"), (3, -1, None), (None, 9, "x")], "id int, v int, g string")


def test_counts_rows_and_nulls(spark, people):
    given = rules.rules_of(spark.createDataFrame([("R1", "p", "v > 0", "positive"), ("R2", "p", "id IS NOT NULL", None), ("R3", "q", "v <> 5 OR g = 'x'", "m")], "id string, scope string, test string, message string"))
    tables = {"p": people, "q": people, "none": people}
    got = {(r.rule, r.dataset): r.n for r in rules.check_rules(tables, given, clean=True).collect()}
    assert got == {("R1", "p"): 1, ("R2", "p"): 1, ("R3", "q"): 0}
    assert {(r.rule, r.dataset) for r in rules.check_rules(tables, given).collect()} == {("R1", "p"), ("R2", "p")}
    assert sorted((str(r.id), r.rule, r.message) for r in rules.violations(people, given[:2], ["id"]).collect()) == [("3", "R1", "positive"), ("None", "R2", "")]
    by = rules.check_rules({"p": people}, given[:1], {"p": "g"}).collect()
    assert [(r.rule, r.dataset, r.n) for r in by] == [("R1", None, 1)]


def test_wrong_rules(spark, people):
    with pytest.raises(ValueError, match="unknown tables"):
        rules.check_rules({"p": people}, [rules.Rule("R", "z", "true")])
    with pytest.raises(ValueError, match="twice"):
        rules.rules_of(spark.createDataFrame([("R", "p", "true", ""), ("R", "p", "false", "")], "id string, scope string, test string, message string"))
    assert rules.check_rules({"p": people.limit(0)}, [rules.Rule("R", "p", "v > 0")], clean=True).first()["n"] == 0


def test_one_scan_per_table(people):
    many = [rules.Rule(f"R{i}", "p", f"v > {i}") for i in range(40)]
    plan = rules.check_rules({"p": people}, many, clean=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("Scan") == 1
