"""Every registered query against its SQL on the smallest tables, and plan rules."""

import duckdb
import pytest

from subjectflow.plans import queries as registry

SF = "/root/testdata/sf0.001"
# On the smallest tables an arm is empty and the model cannot be fitted.
LARGER = dict.fromkeys(["ancova_factor", "ancova_factor_nocov", "ancova_two_arm_report", "ancova_two_arm_pairwise"], "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = registry.QUERIES, registry.SQL

# Windows left in these plans run over reduced tables only: bucket counts of the median
# (bounded number of buckets), one row per arm and day, one row per shuffle partition.
REDUCED_WINDOWS = {
    "describe_by_arm", "layered_summary", "nest_rowlabels", "km_curve", "position_compare", "sorted_position", "pad_row",
}
# Result rows of fitted models pass through a vectorised Python function.
PYTHON_ON_RESULTS = {"ancova_two_arm_report", "ancova_two_arm_pairwise", "ancova_factor", "ancova_factor_nocov", "ancova_factor_report"}


@pytest.fixture(scope="module")
def duck():
    def over(sf):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        return con

    return {sf: over(sf) for sf in {SF, *LARGER.values()}}


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple("~" if r[i] is None else repr(r[i] + 0.0) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    sf = LARGER.get(name, SF)
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if "Window [" in plan and name not in REDUCED_WINDOWS:
        assert plan.count("Window [") <= plan.count("WindowGroupLimit") / 2
    if name not in PYTHON_ON_RESULTS:
        assert "Python" not in plan and "Pandas" not in plan and "MapInPandas" not in plan
    got = comparable(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        return
    cursor = duck[sf].execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == comparable(names, cursor.fetchall())


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["arm", "time", "n_risk", "n_event", "n_censor", "surv", "std_err", "lower", "upper"]
    last = {}
    for r in sorted(df.collect(), key=lambda r: (r.arm, r.time)):
        assert 0.0 <= r.surv <= last.get(r.arm, 1.0)
        last[r.arm] = r.surv


def test_all_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"ancova_factor_report"}
