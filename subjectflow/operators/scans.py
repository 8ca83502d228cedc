"""Running sums and products over groups of any size, and global row numbers.

An ordered group is cut into chunks that follow one another. Each chunk is folded to one
value, these are folded once more over one row per chunk, and what comes before a chunk is
carried into it. No task orders more than one chunk, however large the group is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subjectflow.functions.cells import col
from subjectflow.operators.joins import lookup_join

#: Chunks that a group is cut into.
RANGES = 256

_FOLDS = {
    "sum": (F.sum, 0, lambda a, b: a + b),
    "product": (F.product, 1, lambda a, b: a * b),
    "min": (F.min, None, F.least),
}


def ranged(df: DataFrame, by: Sequence[str], value: str, name: str, ranges: int = RANGES) -> DataFrame:
    """Add the number of the range of ``value`` within its group: about equally many rows each.

    The bounds are approximate quantiles, found by mergeable sketches; equal values are in
    one range, and ranges ascend with the value. Values are not null.
    """
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    bounds = df.groupBy(*by).agg(F.percentile_approx(value, shares, 20 * ranges).alias("_bounds"))
    at = F.size(F.filter("_bounds", lambda b: b < F.col(value)))
    return lookup_join(df, bounds, by, "inner").withColumn(name, at).drop("_bounds")


def scan(
    df: DataFrame, by: Sequence[str], chunk: str, order: Sequence[str | Column], values: Mapping[str, tuple[str, Column]],
    backwards: bool = False, exclusive: bool = False,
) -> DataFrame:
    """Running folds per group: ``values`` maps a new column to ("sum", "product" or "min", what is folded).

    ``chunk`` numbers the chunks of a group in the order of its rows, ``order`` is total within
    a chunk. ``backwards`` folds from the end; ``exclusive`` leaves the row itself out. What is
    folded must not be null in all rows of a chunk.
    """
    by = list(by)
    folded = df.groupBy(*by, chunk).agg(*[_FOLDS[kind][0](c).alias(f"_carry_{name}") for name, (kind, c) in values.items()])
    place = Window.partitionBy(*by).orderBy(F.desc(chunk) if backwards else F.asc(chunk)).rowsBetween(Window.unboundedPreceding, -1)
    carries = folded.select(*by, chunk, *[
        F.coalesce(_FOLDS[kind][0](f"_carry_{name}").over(place), F.lit(_FOLDS[kind][1])).alias(f"_carry_{name}") for name, (kind, _) in values.items()
    ])
    inner = Window.partitionBy(*by, chunk).orderBy(*[col(o).desc() if backwards else col(o).asc() for o in order])
    inner = inner.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    out = lookup_join(df, carries, [*by, chunk], "inner")
    for name, (kind, c) in values.items():
        fold, nothing, join = _FOLDS[kind]
        out = out.withColumn(name, join(F.col(f"_carry_{name}"), F.coalesce(fold(c).over(inner), F.lit(nothing))))
    return out.drop(*[f"_carry_{name}" for name in values])
