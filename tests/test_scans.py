"""Scans over ranges: curves on fine times, row numbers, lines, against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from subjectflow.operators import scans, survival


def _plain_curve(times, events):
    out, surv, green = {}, 1.0, 0.0
    values, start = np.unique(times), len(times)
    order = np.argsort(times, kind="stable")
    t, e = times[order], events[order]
    first, last = np.searchsorted(t, values), np.searchsorted(t, values, side="right")
    sums = np.concatenate([[0], np.cumsum(e)])
    for v, a, b in zip(values.tolist(), first.tolist(), last.tolist(), strict=True):
        n, d = start - a, int(sums[b] - sums[a])
        surv *= 1 - d / n
        green += d / (n * (n - d)) if n > d else 0
        out[v] = (n, d, b - a - d, surv, np.sqrt(green) if surv > 0 else None)
    return out


def test_curve_on_nearly_distinct_times_with_a_hot_arm(spark):
    rows = 300_000
    df = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("arm"), (F.col("id") % 7).cast("string"))).alias("arm"),
        (F.rand(5) * 1000 + F.when(F.col("id") % 50 == 0, F.lit(0.0)).otherwise(F.rand(6))).alias("AVAL"), (F.rand(7) < 0.6).cast("int").alias("CNSR"),
    )
    df = df.withColumn("AVAL", F.when(F.rand(8) < 0.05, F.round("AVAL")).otherwise(F.col("AVAL")))
    held = df.toPandas()
    got = survival.km_curve(spark.createDataFrame(held), "arm").toPandas()
    assert held["arm"].value_counts()["hot"] == rows // 3
    for arm, part in held.groupby("arm"):
        expected = _plain_curve(part["AVAL"].to_numpy(), (part["CNSR"] == 0).to_numpy().astype(int))
        mine = got[got["arm"] == arm].set_index("time").sort_index()
        assert mine.index.tolist() == sorted(expected)
        n, d, c, surv, error = zip(*[expected[t] for t in mine.index], strict=True)
        assert mine["n_risk"].tolist() == list(n) and mine["n_event"].tolist() == list(d) and mine["n_censor"].tolist() == list(c)
        assert np.allclose(mine["surv"], surv, rtol=1e-9, atol=1e-12)
        left = np.array([x is not None for x in error])
        assert np.allclose(mine["std_err"][left], np.array([x for x in error if x is not None]), rtol=1e-9)


def test_curve_orders_no_arm_in_one_task(spark):
    df = spark.range(1000).select(F.lit("a").alias("arm"), F.rand(1).alias("AVAL"), F.lit(0).alias("CNSR"))
    plan = survival.km_curve(df, "arm")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.lstrip(" +-:").startswith("Window")]
    assert windows and all("_range#" in w.split("windowspecdefinition")[1] for w in windows)


def test_ranges_keep_equal_values_together(spark):
    df = spark.createDataFrame([("a", float(i % 40)) for i in range(4000)] + [("b", 1.0), ("c", float("nan")), ("c", 2.0)], "g string, v double")
    placed = scans.ranged(df, ["g"], "v", "r", 8).collect()
    assert len(placed) == 4003
    bounds = {}
    for row in placed:
        bounds.setdefault((row.g, str(row.v)), set()).add(row.r)
    assert all(len(r) == 1 for r in bounds.values())
    ordered = [min(bounds["a", str(float(v))]) for v in range(40)]
    assert ordered == sorted(ordered) and len(set(ordered)) >= 6


@pytest.mark.parametrize("backwards", [False, True])
@pytest.mark.parametrize("exclusive", [False, True])
def test_scan_equals_the_plain_fold(spark, backwards, exclusive):
    rows = [(g, i, i // 7, (i * 37 % 11) + 1) for g, n in (("a", 50), ("b", 1), ("c", 8)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, chunk int, v int")
    values = {"s": ("sum", F.col("v")), "p": ("product", F.col("v") / 6)}
    got = {(r.g, r.i): (r.s, r.p) for r in scans.scan(df, ["g"], "chunk", ["i"], values, backwards, exclusive).collect()}
    assert len(got) == len(rows)
    for g, i, _, _ in rows:
        seen = [v for h, j, _, v in rows if h == g and ((j >= i if backwards else j <= i) and (not exclusive or j != i))]
        assert got[g, i][0] == sum(seen) and got[g, i][1] == pytest.approx(np.prod([v / 6 for v in seen]))


@pytest.mark.parametrize("rows_of_range", [20, 1000, 10**9])
def test_row_numbers_in_any_direction_with_ties(spark, monkeypatch, rows_of_range):
    from subjectflow.operators import picks

    monkeypatch.setattr(picks, "_RANGE_ROWS", rows_of_range)
    rows = [(chance, n % 13 if n % 5 else None, f"t{n % 3}", {"m": n}) for n, chance in enumerate(np.random.default_rng(3).integers(0, 40, 30_000).tolist())]
    df = spark.createDataFrame(rows, "a int, b int, c string, d map<string,int>").repartition(7)
    got = picks.number_rows(df, ["-b", "a"]).select("row_no", "a", "b").collect()
    assert sorted(r.row_no for r in got) == list(range(1, 30_001))
    ordered = [(r.b is None, -(r.b or 0), r.a) for r in sorted(got, key=lambda r: r.row_no)]
    assert ordered == sorted(ordered)
    again = picks.number_rows(df.repartition(3), ["-b", "a", "c"]).agg(F.sum(F.shiftright(F.xxhash64("row_no", "a", "b", "c"), 20))).first()[0]
    assert again == picks.number_rows(df, ["-b", "a", "c"]).agg(F.sum(F.shiftright(F.xxhash64("row_no", "a", "b", "c"), 20))).first()[0]
    plan = picks.number_rows(df, ["a"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert "Checkpoint" not in plan and (rows_of_range == 10**9 or windows and all("_range#" in w for w in windows))


def test_row_numbers_of_few_rows(spark):
    from subjectflow.operators import picks

    one = spark.createDataFrame([("x",)], "a string")
    assert [tuple(r) for r in picks.number_rows(one, ["a"]).collect()] == [("x", 1)]
    assert picks.number_rows(one.limit(0), ["a"]).collect() == []
    same = spark.createDataFrame([(float("nan"),), (None,), (1.0,), (1.0,)], "a double")
    assert sorted(str(r.a) + str(r.row_no) for r in picks.number_rows(same, ["-a"]).collect()) == ["1.02", "1.03", "None4", "nan1"]
