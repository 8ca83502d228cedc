"""General linear models from one mergeable aggregate.

Rows are reduced to one: counts, means and centred cross products of all columns that any of
the models needs, per level of an absorbed factor and then added up. Centred products merge
without cancellation, every task adds up its own rows first, and a factor of any number of
levels needs no indicator columns. Several models may be fitted from the same row, for their
terms are linear combinations of its columns.

A term that is a combination of the terms before it (collinear, constant within the absorbed
factor, or empty) is aliased: it gets no coefficient and uses no degree of freedom, as in the
usual sequential elimination. A contrast is estimable if it doesn't depend on how that was
resolved; others are null, and one with a term that is zero in all rows (an empty group) has no
row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A term whose part that the terms before it don't explain is below this share of it is aliased.
TOLERANCE = 1e-10
INTERCEPT = "(Intercept)"

_FIT = "model string, test string, estimate double, se double, df long, t double, aliased boolean, rmse double"


@dataclass(frozen=True)
class Model:
    """Terms in order, each a combination (column to weight); contrasts, each a combination of terms.

    Without contrasts every term is one. ``intercept`` adds the constant's coefficient to those.
    """

    terms: Mapping[str, Mapping[str, float]]
    response: str
    contrasts: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    intercept: bool = False


def gram(df: DataFrame, columns: Mapping[str, Column | str], absorb: str | None = None) -> DataFrame:
    """One row: ``n``, ``levels``, ``means`` and ``products`` (the upper triangle, row by row) of the complete rows.

    Products are centred within each level of ``absorb``, or overall. No rows give n = 0.
    """
    names = list(columns)
    cells = [(F.col(c) if isinstance(c, str) else c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns.values())]
    rows = df.select(*cells, *([F.col(absorb).alias("_level")] if absorb else [])).dropna()
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = [F.count("*").alias("n"), *[F.avg(f"_c{i}").alias(f"m{i}") for i in range(len(names))], *[F.covar_pop(f"_c{i}", f"_c{j}").alias(f"p{i}_{j}") for i, j in pairs]]
    levels = (rows.groupBy("_level") if absorb else rows).agg(*sums).filter("n > 0")
    means = F.array(*[F.sum(F.col("n") * F.col(f"m{i}")) / F.sum("n") for i in range(len(names))])
    products = F.array(*[F.sum(F.col("n") * F.col(f"p{i}_{j}")) for i, j in pairs])
    return levels.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("levels"), means.alias("means"), products.alias("products"))


def sweep(xtx: np.ndarray, tolerance: float = TOLERANCE) -> tuple[np.ndarray, list[int]]:
    """(generalised inverse, terms that are kept) of a cross product matrix, term after term in order."""
    own, left, kept = np.diag(xtx).copy(), xtx.copy(), []
    for j in range(len(xtx)):
        if own[j] > 0 and left[j, j] > tolerance * own[j]:
            kept.append(j)
            column = left[:, j].copy()
            left = left - np.outer(column, column) / column[j]
    inverse = np.zeros_like(xtx)
    if kept:
        scale = 1 / np.sqrt(own[kept])
        inner = np.linalg.inv(xtx[np.ix_(kept, kept)] * np.outer(scale, scale))
        inverse[np.ix_(kept, kept)] = inner * np.outer(scale, scale)
    return inverse, kept


def _solved(row, names: list[str], models: Mapping[str, Model]) -> list[tuple]:
    """The rows of all models from one row of sums."""
    k, place = len(names), {n: i for i, n in enumerate(names)}
    products = np.zeros((k, k))
    products[np.triu_indices(k)] = row.products
    products = products + np.triu(products, 1).T
    means, out = np.array(row.means, dtype=float), []
    for label, model in models.items():
        terms = list(model.terms)
        weights = np.zeros((len(terms), k))
        for i, combination in enumerate(model.terms.values()):
            for name, w in combination.items():
                weights[i, place[name]] += w
        y = place[model.response]
        xtx, xty = weights @ products @ weights.T, weights @ products[:, y]
        inverse, kept = sweep(xtx)
        beta = inverse @ xty
        df = int(row.n) - int(row.levels) - len(kept)
        sse = max(products[y, y] - float(beta @ xty), 0.0)
        s2 = sse / df if df > 0 else math.nan
        rmse = math.sqrt(sse / row.n)
        empty = (np.diag(xtx) == 0) & (weights @ means == 0)
        contrasts = model.contrasts or {t: {t: 1.0} for t in terms}
        for name, combination in contrasts.items():
            c = np.zeros(len(terms))
            for term, w in combination.items():
                c[terms.index(term)] += w
            if model.contrasts and any(empty[terms.index(t)] for t in combination):
                continue
            scale = np.sqrt(np.maximum(np.diag(xtx), 0))
            off = np.divide(c @ inverse @ xtx - c, scale, out=np.abs(c @ inverse @ xtx - c), where=scale > 0)
            known = bool(np.all(np.abs(off) <= 1e-6 * np.max(np.divide(np.abs(c), scale, out=np.abs(c), where=scale > 0), initial=1e-300)))
            aliased = not known if model.contrasts else terms.index(name) not in kept
            known = known if model.contrasts else not aliased
            estimate = float(c @ beta) if known else math.nan
            se = math.sqrt(s2 * float(c @ inverse @ c)) if known and df > 0 else math.nan
            out.append((label, name, estimate, se, df, estimate / se if se > 0 else math.nan, aliased, rmse))
        if model.intercept and not model.contrasts:
            mx = weights @ means
            estimate = float(means[y] - beta @ mx)
            se = math.sqrt(s2 * (1 / row.n + float(mx @ inverse @ mx))) if df > 0 else math.nan
            out.append((label, INTERCEPT, estimate, se, df, estimate / se if se > 0 else math.nan, False, rmse))
    return out


def fit(sums: DataFrame, columns: Sequence[str], models: Mapping[str, Model]) -> DataFrame:
    """``model``, ``test``, ``estimate``, ``se``, ``df``, ``t``, ``aliased``, ``rmse`` (divisor n) from a row of ``gram``.

    The solve runs on that one row; ``columns`` are those of ``gram``. No rows give no fit.
    """
    names = list(columns)
    heads = [c.split()[0] for c in _FIT.split(", ")]

    def solve(batches):
        for batch in batches:
            yield pd.DataFrame([r for row in batch.itertuples(index=False) for r in _solved(row, names, models)], columns=heads)

    fitted = sums.filter(F.col("n") > 0).mapInPandas(solve, _FIT)
    clean = {c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("estimate", "se", "t", "rmse")}
    return fitted.select(*[clean[c].alias(c) if c in clean else F.col(c) for c in heads])


def linear_model(df: DataFrame, response: str, terms: Sequence[str] | Mapping[str, Column], absorb: str | None = None) -> DataFrame:
    """Coefficients of ``response ~ terms`` with an absorbed factor, if any: one row per term, and the intercept without one."""
    given = dict(terms) if isinstance(terms, Mapping) else {t: F.col(t) for t in terms}
    columns = {**given, "_response": F.col(response)}
    model = Model({t: {t: 1.0} for t in given}, "_response", intercept=absorb is None)
    return fit(gram(df, columns, absorb), list(columns), {response: model}).withColumnRenamed("test", "term").drop("model")
