"""Choosing rows: first/last per group, flags on chosen rows, group extremes.

No operator here sorts or buffers a whole group in one task. A choice is made by a
pre-aggregating plan (a rank limit before the shuffle, or a partial ``min``), and a
flag travels back to the rows on the row key, which spreads evenly however uneven
the groups are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subjectflow.functions.cells import col
from subjectflow.operators.joins import lookup_join


def sort_keys(order: Sequence[str | Column], reverse: bool = False) -> list[Column]:
    """Sort columns with nulls last in both directions; ``-name`` sorts down.

    ``reverse`` turns the whole order round, so nulls then come first.
    """
    keys = []
    for item in order:
        down = isinstance(item, str) and item.startswith("-")
        c = F.col(item[1:]) if down else col(item)
        if reverse:
            keys.append(c.asc_nulls_first() if down else c.desc_nulls_first())
        else:
            keys.append(c.desc_nulls_last() if down else c.asc_nulls_last())
    return keys


def order_struct(order: Sequence[str | Column], *payload: str) -> Column:
    """A struct that compares like ``order`` ascending with nulls last, then by payload."""
    fields = []
    for i, item in enumerate(order):
        c = col(item)
        fields += [c.isNull().alias(f"n{i}"), c.alias(f"o{i}")]
    return F.struct(*fields, *[F.col(p) for p in payload])


def pick_row(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], mode: str = "first") -> DataFrame:
    """One whole row per group: the first or last in ``order`` (nulls sort last).

    ``row_number() = 1`` is planned with a rank limit on both sides of the shuffle, so
    each task sends at most one row per group. The order must be total for a stable
    result: end it with a row key.
    """
    window = Window.partitionBy(*by).orderBy(*sort_keys(order, reverse=mode == "last"))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def flag_extreme(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    row_key: Sequence[str],
    name: str,
    mode: str = "first",
    where: Column | None = None,
    value: str = "Y",
) -> DataFrame:
    """``value`` in ``name`` on the first/last row per group among rows meeting ``where``.

    Other rows pass through with null. ``row_key`` identifies a row and also breaks ties.
    """
    pool = df if where is None else df.filter(where)
    needed = list(dict.fromkeys([*by, *row_key, *_names(order)]))
    extra = [o for o in order if not isinstance(o, str)]
    pool = pool.select(*needed) if not extra else pool
    chosen = pick_row(pool, by, [*order, *row_key], mode)
    marks = chosen.select(*row_key, F.lit(value).alias(name))
    return df.join(marks, list(row_key), "left")


def _names(order: Sequence[str | Column]) -> list[str]:
    return [o.lstrip("-") for o in order if isinstance(o, str)]


def flag_first_nested(
    df: DataFrame,
    levels: Sequence[Sequence[str]],
    order: Sequence[str],
    row_key: Sequence[str],
    conditions: Mapping[str, Column],
    flags: Mapping[str, tuple[int, str]],
    where: Column | None = None,
) -> DataFrame:
    """Many first-occurrence flags over nested groups in one reduction.

    ``levels`` lists the group keys from coarse to fine, each contained in the next;
    ``flags`` maps a flag name to (level index, condition name); ``where`` is a test that
    every condition implies, if there is one. The finest level is reduced once with one minimum per condition; each coarser level is reduced from the
    level below. The winners return to the rows on ``row_key``.
    """
    mark = order_struct(order, *row_key)
    wanted: dict[tuple[int, str], list[str]] = {}
    for name, (level, condition) in flags.items():
        wanted.setdefault((level, condition), []).append(name)

    any_condition = where
    for condition in () if where is not None else conditions.values():
        any_condition = condition if any_condition is None else any_condition | condition
    finest = len(levels) - 1
    reduced = (
        df.filter(any_condition)
        .groupBy(*levels[finest])
        .agg(*[F.min(F.when(test, mark)).alias(f"_w_{key}") for key, test in conditions.items()])
    )
    winners = None
    for level in range(finest, -1, -1):
        if level < finest:
            reduced = reduced.groupBy(*levels[level]).agg(
                *[F.min(f"_w_{key}").alias(f"_w_{key}") for key in conditions]
            )
        # Every level emits every condition, so that the levels share one reduced plan and
        # Spark reuses its shuffles; marks without a flag vanish below.
        entries = [
            F.when(
                F.col(f"_w_{condition}").isNotNull(),
                F.struct(
                    *[F.col(f"_w_{condition}.{k}").alias(k) for k in row_key],
                    *[_mark(flag in wanted.get((level, condition), ())).alias(flag) for flag in flags],
                ),
            )
            for condition in conditions
        ]
        part = reduced.select(F.explode(F.array(*entries)).alias("_e")).filter(F.col("_e").isNotNull()).select("_e.*")
        winners = part if winners is None else winners.unionByName(part)
    marks = winners.groupBy(*row_key).agg(*[F.max(flag).alias(flag) for flag in flags])
    return df.join(marks, list(row_key), "left")


def _mark(yes: bool) -> Column:
    return F.lit("Y" if yes else None).cast("string")


def restrict_columns(df: DataFrame, columns: Mapping[str, Column], where: Column) -> DataFrame:
    """Row-wise derivations on the rows meeting ``where``, null elsewhere, in one pass."""
    return df.withColumns({name: F.when(where, c) for name, c in columns.items()})


def restrict(df: DataFrame, derivation, where: Column, **args) -> DataFrame:
    """Run ``derivation`` on the rows meeting ``where``; the others pass through with nulls.

    For derivations over groups or ones that add rows; the input is read once per part.
    Row-wise columns are cheaper with ``restrict_columns``.
    """
    inside = derivation(df.filter(where), **args)
    outside = df.filter(~F.coalesce(where, F.lit(False)))
    return inside.unionByName(outside, allowMissingColumns=True)


def flag_group_max(
    df: DataFrame, by: Sequence[str], value: str, name: str, max_name: str | None = None, no: str = ""
) -> DataFrame:
    """Keep the group maximum on each row and flag the rows that reach it.

    The flag is null where the value is null.
    """
    top = max_name or f"_max_{value}"
    best = df.groupBy(*by).agg(F.max(value).alias(top))
    out = lookup_join(df, best, by).withColumn(
        name, F.when(F.col(value) == F.col(top), F.lit("Y")).when(F.col(value) != F.col(top), F.lit(no))
    )
    return out if max_name else out.drop(top)


#: Ranges of a global order are found in two steps of this many; rows sampled per range; rows of a range that are worth another.
_STEP, _SAMPLED, _RANGE_ROWS = 32, 16, 100_000


def _reached(keys: Sequence[tuple[Column, bool]], bound: Column) -> Column:
    """Whether a row stands at or behind a bound in the order of ``sort_keys``: nulls last, either direction."""
    test = F.lit(True)
    for i, (c, down) in reversed(list(enumerate(keys))):
        other = bound[f"k{i}"]
        beyond = F.when(c.isNull(), other.isNotNull()).otherwise(F.coalesce(c < other if down else c > other, F.lit(False)))
        test = beyond | (c.eqNullSafe(other) & test)
    return test


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row_no", unique: bool = False) -> DataFrame:
    """Global 1-based row numbers in ``order`` without a single-task window or a checkpoint.

    Bounds that cut the order into up to 1,024 ranges come from a sample of some 16,000 rows
    (those whose hashes are smallest, so reruns agree), for which a job is run. The rows of a
    range are numbered together, after the rows of the ranges before, whose counts are one
    row per range. Rows that tie in ``order`` are told apart by a hash of the whole row, unless
    the order is ``unique``; then only its columns are read for sample and counts.
    """
    keys = [(F.col(o[1:] if o.startswith("-") else o) if isinstance(o, str) else o, isinstance(o, str) and o.startswith("-")) for o in order]
    hashed = [f"`{f.name}`" for f in df.schema if not isinstance(f.dataType, T.MapType)]
    if not unique:
        keys.append((F.xxhash64(*hashed), False))
    sort = [c.desc_nulls_last() if down else c.asc_nulls_last() for c, down in keys]
    parts = [c.alias(f"k{i}") for i, (c, _) in enumerate(keys)]
    rows = df.select(*parts)
    sample = rows.withColumn("_h", F.xxhash64(*rows.columns, F.lit(29))).orderBy("_h").limit(_SAMPLED * _STEP**2)
    ordered = [F.col(f"k{i}").desc_nulls_last() if down else F.col(f"k{i}").asc_nulls_last() for i, (_, down) in enumerate(keys)]
    places = sample.select(F.struct(*rows.columns).alias("b"), "_h", F.ntile(_STEP**2).over(Window.orderBy(*ordered)).alias("_t"), F.row_number().over(Window.orderBy(*ordered)).alias("_n"))
    cuts = places.groupBy("_t").agg(F.to_json(F.min_by("b", "_n")).alias("b"), F.max("_h").alias("h"), F.count("*").alias("n")).orderBy("_t").collect()
    # the largest of the smallest hashes tells about how many rows there are
    seen, reach = sum(r["n"] for r in cuts), max((r["h"] for r in cuts), default=0) + (1 << 63)
    about = seen if seen < _SAMPLED * _STEP**2 else seen * (1 << 64) // max(1, reach)
    ranges = min(len(cuts), 1 + about // _RANGE_ROWS)
    # one literal: bounds in groups; a format that shortens a value only moves a bound
    texts = [cuts[i * len(cuts) // ranges]["b"] for i in range(1, ranges)] if cuts else []
    groups = "[" + ",".join("[" + ",".join(texts[i : i + _STEP]) + "]" for i in range(0, len(texts), _STEP)) + "]"
    known = F.from_json(F.lit(groups), T.ArrayType(T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]))))
    coarse = F.size(F.filter(known, lambda g: _reached(keys, g[0])))
    fine = F.filter(F.element_at(known, F.greatest(coarse, F.lit(1))), lambda b: _reached(keys, b))
    place = F.when(coarse > 0, coarse * _STEP + F.size(fine)).otherwise(0) if texts else F.lit(0)
    placed = df.withColumn("_range", place)
    # at most one row per range, so this window and the broadcast are small whatever the data size
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*sort))
    return placed.withColumn(name, within).join(F.broadcast(offsets), "_range").withColumn(name, F.col("_before") + F.col(name)).drop("_range", "_before")
