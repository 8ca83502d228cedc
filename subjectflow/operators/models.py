"""Analysis of covariance from one pass of grouped sums.

The rows are only ever aggregated: a model is fitted from counts, means and centred
cross products per cell, however large the table. A factor such as site is absorbed
cell by cell, so there are no indicator columns and any number of sites works.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subjectflow.functions.stats import t_quantile, t_two_sided
from subjectflow.operators.linear import Model, fit, gram


def _complete(df: DataFrame, *names: str) -> DataFrame:
    return df.dropna(subset=list(names))


# ----------------------------------------------------------- two arms, one covariate
def ancova_two_arm(df: DataFrame, y: str, x: str, arm: str, arms: Sequence) -> DataFrame:
    """One row with the fit of ``y ~ x + arm`` for two arms; no row if an arm is empty.

    Columns: per arm (suffix 1, 2) n, LS mean at the overall covariate mean and its
    standard error; slope, residual df, difference (arm 1 - arm 2) with standard error,
    and the root mean squared error with divisor n.
    """
    cells = []
    for i, a in enumerate(arms, start=1):
        here = F.col(arm) == F.lit(a)
        xi, yi = F.when(here, F.col(x).cast("double")), F.when(here, F.col(y).cast("double"))
        cells += [
            F.count(yi).alias(f"n{i}"),
            F.avg(xi).alias(f"x{i}"),
            F.avg(yi).alias(f"y{i}"),
            F.var_pop(xi).alias(f"vx{i}"),
            F.covar_pop(xi, yi).alias(f"cv{i}"),
            F.var_pop(yi).alias(f"vy{i}"),
        ]
    sums = _complete(df, x, y).agg(*cells).filter((F.col("n1") > 0) & (F.col("n2") > 0))

    def both(name: str) -> Column:
        return F.col("n1") * F.col(f"{name}1") + F.col("n2") * F.col(f"{name}2")

    fit = sums.withColumns({"n": F.col("n1") + F.col("n2"), "sxx": both("vx"), "sxy": both("cv"), "syy": both("vy")})
    fit = fit.withColumns({"slope": F.try_divide("sxy", "sxx"), "df": F.col("n") - 3, "xbar": F.try_divide(both("x"), F.col("n"))})
    fit = fit.withColumn("sse", F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0)))
    fit = fit.withColumn("s2", F.when(F.col("df") > 0, F.col("sse") / F.col("df")))
    out = {"rmse": F.sqrt(F.try_divide("sse", "n"))}
    for i in (1, 2):
        off = F.col(f"x{i}") - F.col("xbar")
        out[f"lsmean{i}"] = F.col(f"y{i}") - F.col("slope") * off
        out[f"se{i}"] = F.sqrt(F.col("s2") * (F.try_divide(F.lit(1.0), F.col(f"n{i}")) + off * off / F.col("sxx")))
    gap = F.col("x1") - F.col("x2")
    inverse_n = F.try_divide(F.lit(1.0), F.col("n1")) + F.try_divide(F.lit(1.0), F.col("n2"))
    out["diff"] = F.col("y1") - F.col("y2") - F.col("slope") * gap
    out["diff_se"] = F.sqrt(F.col("s2") * (inverse_n + gap * gap / F.col("sxx")))
    fit = fit.withColumns(out)
    return fit.select("n1", "n2", "slope", "df", "lsmean1", "se1", "lsmean2", "se2", "diff", "diff_se", "rmse")


def _t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) if a is not None and b is not None else None for a, b in zip(t, df)], dtype="float64")


def _t_critical(df: pd.Series) -> pd.Series:
    return pd.Series([t_quantile(0.95, b) if b is not None else None for b in df], dtype="float64")


def t_p_value(t: Column, df: Column) -> Column:
    """Two-sided p-value; meant for result rows, not for data rows."""
    return F.nanvl(F.pandas_udf(_t_tail, "double")(t.cast("double"), df.cast("double")), F.lit(None).cast("double"))


def t_critical(df: Column) -> Column:
    """95 % two-sided critical value; meant for result rows."""
    return F.nanvl(F.pandas_udf(_t_critical, "double")(df.cast("double")), F.lit(None).cast("double"))


def ancova_two_arm_report(fit: DataFrame, arms: Sequence) -> DataFrame:
    """LS means with t limits per arm (rows) from a two-arm fit."""
    critical = fit.withColumn("_q", t_critical(F.col("df")))
    rows = F.array(*[
        F.struct(F.lit(a).alias("arm"), F.col(f"n{i}").alias("n"), F.col(f"lsmean{i}").alias("lsmean"), F.col(f"se{i}").alias("se"))
        for i, a in enumerate(arms, start=1)
    ])
    tall = critical.select("df", "_q", F.explode(rows).alias("_e")).select("_e.*", "df", "_q")
    return tall.select(
        "arm", "n", "lsmean", "se", "df",
        (F.col("lsmean") - F.col("_q") * F.col("se")).alias("lower"),
        (F.col("lsmean") + F.col("_q") * F.col("se")).alias("upper"),
        (F.col("se") * F.sqrt(F.col("df"))).alias("lsmean_sd"),
    )


def pairwise_report(fit: DataFrame) -> DataFrame:
    """Difference with limits at 1.96 standard errors and its t-test p-value."""
    return fit.select(
        F.col("diff").alias("estimate"), F.col("diff_se").alias("se"), "df",
        (F.col("diff") - 1.96 * F.col("diff_se")).alias("lower"),
        (F.col("diff") + 1.96 * F.col("diff_se")).alias("upper"),
        t_p_value(F.try_divide("diff", "diff_se"), F.col("df")).alias("p_value"),
        "rmse",
    )


# ------------------------------------------------- arms and an absorbed factor
def _factor_models(arms: Sequence, doses: Sequence[float], labels: Sequence[str], covariate: bool) -> dict[str, Model]:
    """``dose``: slope of the numeric dose (its F test with one degree of freedom is t squared);
    ``arms``: every pairwise contrast with the arms as a factor. Both beside the covariate, if any."""
    k, x = len(arms), {"x": {"x": 1.0}} if covariate else {}
    dose = {f"arm{i}": float(w) for i, w in enumerate(doses)}
    pairs = {f"{labels[i]} - {labels[j]}": {f"arm{i}": 1.0, f"arm{j}": -1.0} for i in range(k) for j in range(i + 1, k)}
    return {
        "dose": Model({"dose": dose, **x}, "y", {"dose": {"dose": 1.0}}),
        "arms": Model({**{f"arm{i}": {f"arm{i}": 1.0} for i in range(k)}, **x}, "y", pairs),
    }


def ancova_factor(
    df: DataFrame, y: str, arm: str, arms: Sequence, doses: Sequence[float], labels: Sequence[str], factor: str,
    covariate: str | None = None,
) -> DataFrame:
    """Dose-response test and pairwise contrasts of ``y ~ arm + factor (+ covariate)``.

    Pairwise limits use the t quantile, p-values are unadjusted. Both models come from one
    row of sums (``linear.gram``); a contrast with an empty arm has no row.
    """
    columns = {f"arm{i}": (F.col(arm) == F.lit(a)).cast("double") for i, a in enumerate(arms)} | {"y": F.col(y)}
    if covariate:
        columns["x"] = F.col(covariate)
    sums = gram(df.filter(F.col(arm).isin(list(arms))), columns, factor)
    found = fit(sums, list(columns), _factor_models(arms, doses, labels, covariate is not None))
    q = found.withColumns({"p_value": t_p_value(F.col("t"), F.col("df")), "_q": t_critical(F.col("df"))})
    return q.select(
        "test", "estimate", "se", "df",
        (F.col("estimate") - F.col("_q") * F.col("se")).alias("lower"),
        (F.col("estimate") + F.col("_q") * F.col("se")).alias("upper"),
        "p_value",
    )


