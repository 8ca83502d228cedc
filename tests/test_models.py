"""Models against a plain least-squares fit with indicator columns."""

import math

import numpy as np
import pytest

from subjectflow.functions.stats import t_quantile, t_two_sided
from subjectflow.operators import models


def ols(x, y):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ beta
    df = len(y) - np.linalg.matrix_rank(x)
    s2 = float(resid @ resid) / df
    return beta, s2 * np.linalg.pinv(x.T @ x), df, float(resid @ resid)


@pytest.fixture(scope="module")
def trial():
    rng = np.random.default_rng(3)
    n = 240
    arm = rng.choice(["Hi", "Lo", "Pbo"], n)
    site = rng.choice([f"s{i}" for i in range(9)], n, p=[0.4] + [0.075] * 8)
    base = rng.normal(25, 8, n)
    dose = np.select([arm == "Hi", arm == "Lo"], [81.0, 54.0], 0.0)
    y = 3 - 0.2 * base - 0.02 * dose + np.array([int(s[1]) for s in site]) * 0.3 + rng.normal(0, 4, n)
    return arm, site, base, dose, y


def frame(spark, trial):
    arm, site, base, dose, y = trial
    rows = [(str(a), str(s), float(b), float(v)) for a, s, b, v in zip(arm, site, base, y)]
    rows += [("Hi", "s0", None, 1.0), ("Hi", "s0", 1.0, None), ("Other", "s0", 1.0, 1.0)]  # incomplete or foreign rows drop out
    return spark.createDataFrame(rows, "arm string, site string, base double, y double").repartition(5)


@pytest.mark.parametrize("covariate", [True, False])
def test_factor_models_equal_indicator_fit(spark, trial, covariate):
    arm, site, base, dose, y = trial
    sites = np.column_stack([(site == s).astype(float) for s in sorted(set(site))])
    extra = [base] if covariate else []
    b1, v1, df1, _ = ols(np.column_stack([dose, sites, *extra]), y)
    b2, v2, df2, _ = ols(np.column_stack([arm == "Hi", arm == "Lo", sites, *extra]).astype(float), y)
    want = {"dose": (b1[0], math.sqrt(v1[0, 0]), df1)}
    for name, c in (("Hi - Lo", [1, -1]), ("Hi - Pbo", [1, 0]), ("Lo - Pbo", [0, 1])):
        c = np.array(c + [0] * (len(b2) - 2), dtype=float)
        want[name] = (float(c @ b2), math.sqrt(float(c @ v2 @ c)), df2)
    df = frame(spark, trial) if covariate else frame(spark, trial).filter("base is not null")
    got = models.ancova_factor(df, "y", "arm", ["Hi", "Lo", "Pbo"], [81, 54, 0], ["Hi", "Lo", "Pbo"], "site", "base" if covariate else None)
    rows = {r.test: r for r in got.collect()}
    assert set(rows) == set(want)
    for name, (estimate, se, df) in want.items():
        r = rows[name]
        assert (r.estimate, r.se, r.df) == (pytest.approx(estimate, rel=1e-9), pytest.approx(se, rel=1e-9), df)
        assert r.p_value == pytest.approx(t_two_sided(estimate / se, df), rel=1e-9)
        assert r.upper - r.estimate == pytest.approx(t_quantile(0.95, df) * se, rel=1e-9)


def test_empty_arm_gives_null_contrasts_not_errors(spark, trial):
    df = frame(spark, trial).filter("arm <> 'Lo'")
    rows = {r.test: r for r in models.ancova_factor(df, "y", "arm", ["Hi", "Lo", "Pbo"], [81, 54, 0], ["Hi", "Lo", "Pbo"], "site", "base").collect()}
    assert set(rows) == {"dose", "Hi - Pbo"}
    assert rows["Hi - Pbo"].estimate == pytest.approx(rows["dose"].estimate * 81, rel=1e-8)


def test_no_rows_gives_no_results(spark, trial):
    df = frame(spark, trial).filter("arm = 'none'")
    assert models.ancova_factor(df, "y", "arm", ["Hi", "Lo", "Pbo"], [81, 54, 0], ["Hi", "Lo", "Pbo"], "site", "base").count() == 0


def test_two_arm_model(spark, trial):
    arm, site, base, dose, y = trial
    keep = arm != "Lo"
    x = np.column_stack([arm[keep] == "Hi", arm[keep] == "Pbo", base[keep]]).astype(float)
    b, v, df, sse = ols(x, y[keep])
    xbar = base[keep].mean()
    fit = models.ancova_two_arm(frame(spark, trial), "y", "base", "arm", ["Hi", "Pbo"])
    r = fit.first()
    assert (r.n1, r.n2, r.df) == (int((arm == "Hi").sum()), int((arm == "Pbo").sum()), df)
    for i, c in ((1, [1, 0, xbar]), (2, [0, 1, xbar])):
        c = np.array(c)
        assert r[f"lsmean{i}"] == pytest.approx(float(c @ b), rel=1e-10)
        assert r[f"se{i}"] == pytest.approx(math.sqrt(float(c @ v @ c)), rel=1e-10)
    assert r.diff == pytest.approx(b[0] - b[1], rel=1e-10)
    c = np.array([1, -1, 0.0])
    assert r.diff_se == pytest.approx(math.sqrt(float(c @ v @ c)), rel=1e-10)
    assert r.rmse == pytest.approx(math.sqrt(sse / keep.sum()), rel=1e-10)
    pair = models.pairwise_report(fit).first()
    assert pair.upper - pair.estimate == pytest.approx(1.96 * r.diff_se)
    assert pair.p_value == pytest.approx(t_two_sided(r.diff / r.diff_se, df))
    report = {x.arm: x for x in models.ancova_two_arm_report(fit, ["Hi", "Pbo"]).collect()}
    assert report["Hi"].upper - report["Hi"].lsmean == pytest.approx(t_quantile(0.95, df) * r.se1)


def test_two_arm_model_agrees_with_mllib(spark, trial):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df = frame(spark, trial).filter("arm in ('Hi', 'Pbo')").dropna().selectExpr("y", "base", "cast(arm = 'Hi' as double) as t")
    data = VectorAssembler(inputCols=["base", "t"], outputCol="features").transform(df)
    lib = LinearRegression(labelCol="y", solver="normal").fit(data)
    r = models.ancova_two_arm(frame(spark, trial), "y", "base", "arm", ["Hi", "Pbo"]).first()
    assert r.slope == pytest.approx(lib.coefficients[0], rel=1e-9) and r.diff == pytest.approx(lib.coefficients[1], rel=1e-9)
    assert r.rmse == pytest.approx(lib.summary.rootMeanSquaredError, rel=1e-9)
