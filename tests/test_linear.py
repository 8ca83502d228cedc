"""The general linear model against least squares on indicator columns."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from subjectflow.operators import linear


def _plain(x, y):
    """Coefficients, standard errors, df by orthogonalising column after column; None for columns that add nothing."""
    kept, basis = [], []
    for j in range(x.shape[1]):
        rest = x[:, j].astype(float)
        for _ in range(2):
            for b in basis:
                rest = rest - b * (b @ rest)
        if np.linalg.norm(rest) > 1e-6 * max(1e-300, np.linalg.norm(x[:, j])):
            kept.append(j)
            basis.append(rest / np.linalg.norm(rest))
    beta, *_ = np.linalg.lstsq(x[:, kept], y, rcond=None)
    df = len(y) - len(kept)
    s2 = ((y - x[:, kept] @ beta) ** 2).sum() / df
    se = np.sqrt(s2 * np.diag(np.linalg.inv(x[:, kept].T @ x[:, kept])))
    return {j: (b, s) for j, b, s in zip(kept, beta, se, strict=True)}, df


@pytest.fixture(scope="module")
def data(spark):
    chance = np.random.default_rng(4)
    n = 3000
    held = pd.DataFrame({"a": chance.normal(1e4, 1, n), "b": chance.integers(0, 5, n).astype(float), "zero": 0.0, "site": np.where(chance.random(n) < 1 / 3, "hot", "s" + pd.Series(chance.integers(0, 300, n)).astype(str))})
    held["mixed"] = 2 * held["a"] - held["b"]
    held["c"] = held["b"] ** 2 + chance.normal(size=n)
    held["y"] = 3 + 2 * held["a"] - held["c"] + chance.normal(size=n)
    return held


@pytest.mark.parametrize("absorb", [None, "site"])
def test_collinear_terms_are_aliased(spark, data, absorb):
    terms = ["a", "b", "zero", "mixed", "c"]
    design = pd.get_dummies(data["site"]).to_numpy(dtype=float) if absorb else np.ones((len(data), 1))
    want, df = _plain(np.hstack([design, data[terms].to_numpy()]), data["y"].to_numpy())
    holes = data.copy()
    holes.loc[len(data)] = {"a": None, "b": 1.0, "zero": 0.0, "site": "hot", "mixed": 0.0, "c": 1.0, "y": 1.0}
    rows = {r.term: r for r in linear.linear_model(spark.createDataFrame(holes).replace(float("nan"), None).repartition(5), "y", terms, absorb).collect()}
    assert set(rows) == {*terms, *([] if absorb else [linear.INTERCEPT])}
    for i, term in enumerate(terms):
        r = rows[term]
        assert r.aliased == (design.shape[1] + i not in want) and r.df == df
        if r.aliased:
            assert r.estimate is None and r.se is None
        else:
            assert (r.estimate, r.se) == (pytest.approx(want[design.shape[1] + i][0], rel=1e-5), pytest.approx(want[design.shape[1] + i][1], rel=1e-5))
    if not absorb:
        assert rows[linear.INTERCEPT].estimate == pytest.approx(want[0][0], rel=1e-4) and rows[linear.INTERCEPT].se == pytest.approx(want[0][1], rel=1e-4)


def test_contrasts_and_estimability(spark):
    rows = [("A", "s1", 1.0), ("A", "s1", 2.0), ("B", "s1", 4.0), ("C", "s2", 9.0), ("C", "s2", 7.0)]
    df = spark.createDataFrame(rows, "arm string, site string, y double")
    columns = {a: (F.col("arm") == a).cast("double") for a in "ABCD"} | {"y": F.col("y")}
    contrasts = {f"{a} - {b}": {a: 1.0, b: -1.0} for a, b in ("AB", "AC", "BC", "AD")}
    model = linear.Model({a: {a: 1.0} for a in "ABCD"}, "y", contrasts)
    got = {r.test: r.estimate for r in linear.fit(linear.gram(df, columns, "site"), list(columns), {"m": model}).collect()}
    assert got == {"A - B": pytest.approx(-2.5), "A - C": None, "B - C": None}  # C is alone in its site; D has no row
    whole = {r.test: r.estimate for r in linear.fit(linear.gram(df, columns), list(columns), {"m": model}).collect()}
    assert whole == {"A - B": pytest.approx(-2.5), "A - C": pytest.approx(-6.5), "B - C": pytest.approx(-4.0)}


def test_no_rows_and_no_freedom(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 5.0)], "x double, y double")
    assert linear.linear_model(df.limit(0), "y", ["x"]).collect() == []
    r = {x.term: x for x in linear.linear_model(df, "y", ["x"]).collect()}
    assert r["x"].estimate == pytest.approx(3) and r["x"].se is None and r["x"].df == 0 and r[linear.INTERCEPT].estimate == pytest.approx(-1)
