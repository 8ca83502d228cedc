"""Values to labelled ranges: text range codelists, analysis visit windows, tables of intervals.

Ranges that are few and known when the plan is built become conditional expressions: no
join, no shuffle. Ranges that are rows of a table are looked up by ``interval_lookup``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subjectflow.functions.cells import col
from subjectflow.operators.joins import lookup_join

_BOUND = re.compile(r"^\s*(<=|>=|<|>)\s*(-?[\d.]+)\s*$")
_SPAN = re.compile(r"^\s*(-?[\d.]+)\s*-\s*(<?)\s*(-?[\d.]+)\s*$")


def in_range(c: str | Column, text: str) -> Column:
    """Test of a range text such as ``<65``, ``65-80`` (both ends inside),
    ``25-<30`` (upper end outside) or ``>80``."""
    c = col(c)
    bound = _BOUND.match(text)
    if bound:
        op, number = bound.group(1), float(bound.group(2))
        return {"<": c < number, "<=": c <= number, ">": c > number, ">=": c >= number}[op]
    span = _SPAN.match(text)
    if not span:
        raise ValueError(f"not a range: {text!r}")
    low, high = float(span.group(1)), float(span.group(3))
    return (c >= low) & (c < high if span.group(2) else c <= high)


def range_category(
    df: DataFrame, source: str, ranges: Sequence[str], target: str, target_number: str | None = None
) -> DataFrame:
    """Range label of ``source`` in ``target`` and, optionally, its 1-based position."""
    label, number = F, F
    for position, text in enumerate(ranges, start=1):
        test = in_range(source, text)
        label, number = label.when(test, F.lit(text)), number.when(test, F.lit(position))
    out = df.withColumn(target, label)
    return out.withColumn(target_number, number) if target_number else out


@dataclass(frozen=True)
class VisitWindow:
    """A day window that defines an analysis visit; ``None`` leaves a side open."""

    label: str
    number: int
    text: str
    low: int | None
    high: int | None
    target: int

    def covers(self, day: Column) -> Column:
        if self.low is None:
            return day <= self.high
        if self.high is None:
            return day >= self.low
        return (day >= self.low) & (day <= self.high)


def windows(rows: Sequence[tuple]) -> list[VisitWindow]:
    """(label, number, range text, low, high, target) tuples to windows."""
    return [VisitWindow(*row) for row in rows]


def _attributes(w: VisitWindow) -> Column:
    return F.struct(
        F.lit(w.label).alias("AVISIT"),
        F.lit(w.number).alias("AVISITN"),
        F.lit(w.text).alias("AWRANGE"),
        F.lit(w.target).alias("AWTARGET"),
        F.lit(w.low).cast("int").alias("AWLO"),
        F.lit(w.high).cast("int").alias("AWHI"),
    )


def visit_of_day(df: DataFrame, windows: Sequence[VisitWindow], day: str = "ADY") -> DataFrame:
    """Add AVISIT, AVISITN and the window attributes of the window holding ``day``."""
    chain = F
    for w in windows:
        chain = chain.when(w.covers(F.col(day)), _attributes(w))
    return _spread(df, chain)


def window_of_visit(df: DataFrame, windows: Sequence[VisitWindow], visit: str = "AVISIT") -> DataFrame:
    """(Re-)attach AWRANGE, AWTARGET, AWLO, AWHI by visit label."""
    chain = F
    for w in windows:
        chain = chain.when(F.col(visit) == w.label, _attributes(w))
    keep = [c for c in df.columns if c not in ("AWRANGE", "AWTARGET", "AWLO", "AWHI")]
    return _spread(df.select(*keep), chain, ("AWRANGE", "AWTARGET", "AWLO", "AWHI"))


def _spread(df: DataFrame, chain: Column, fields=("AVISIT", "AVISITN", "AWRANGE", "AWTARGET", "AWLO", "AWHI")) -> DataFrame:
    return df.withColumn("_w", chain).select(*df.columns, *[F.col(f"_w.{f}").alias(f) for f in fields])


def window_deviation(df: DataFrame, day: str = "ADY", unit: str = "DAYS") -> DataFrame:
    """AWTDIFF, the distance of the day from the window target, and its unit."""
    return df.withColumn("AWTDIFF", F.abs(F.col("AWTARGET") - F.col(day))).withColumn("AWU", F.lit(unit))


#: Level of intervals without length: cells of about 1e-9.
_POINT_LEVEL = -30
#: Shares of a group's values when they are told the widths of its grids.
_SHARES = 16


def _as_number(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(c.cast("timestamp"), F.current_timezone())).cast("double")
    return c.cast("double")


def _cell(number: Column, level: Column) -> Column:
    """Number of the cell of width 2^level; scaling by a power of two is exact."""
    scaled = number / F.pow(F.lit(2.0), level)
    return scaled - F.pmod(scaled, F.lit(1.0))


def interval_lookup(
    df: DataFrame, value: str, intervals: DataFrame, low: str, high: str, columns: Sequence[str], by: Sequence[str] = (),
    ends: str = "[]", overlaps: str = "refuse",
) -> DataFrame:
    """Add ``columns`` of the interval that holds ``value``; null where none does.

    ``intervals`` is a table with the bounds ``low`` and ``high`` (null: open) and, where
    windows differ by parameter or the like, the keys ``by``; ``ends`` tells which bounds belong
    to it. If several hold a value, that is an error, or with ``overlaps="list"`` the row
    comes once for each. Intervals that hold nothing (``low`` above ``high``) are ignored.

    A range condition alone would be a nested loop. Here every interval lies in at most two cells
    of a grid whose width is the power of two next to its length; so of intervals that don't
    overlap only a few share a cell, however uneven they are. Each distinct value asks for its
    cell at every width there is in its group (and for the open intervals), an equality join
    finds the candidates, and the exact test decides.
    """
    if ends not in ("[]", "[)", "(]", "()") or overlaps not in ("refuse", "list"):
        raise ValueError(f"unknown ends {ends!r} or overlaps {overlaps!r}")
    by, columns = list(by), list(columns)
    keys = [f"_by{i}" for i in range(len(by))]
    given = intervals.select(
        *[F.col(k).alias(a) for k, a in zip(by, keys, strict=True)], F.col(low).alias("_low"), F.col(high).alias("_high"),
        F.struct(*[F.col(c) for c in columns]).alias("_found"),
    ).filter(F.coalesce(F.col("_low") <= F.col("_high"), F.lit(True)))
    kinds = {n: intervals.schema[c].dataType for n, c in (("_low", low), ("_high", high))}
    first, last = (_as_number(F.col(n), kinds[n]) for n in ("_low", "_high"))
    length = (last - first) * (1 + 1e-12)  # a rounded difference may be too small
    near = F.ceil(F.log2(length)).cast("int")
    level = F.when(length == 0, _POINT_LEVEL).otherwise(near + (F.pow(F.lit(2.0), near) < length).cast("int"))
    placed = given.withColumn("_level", level)  # null: open
    cells = F.when(F.col("_level").isNull(), F.array(F.lit(0.0))).otherwise(F.array_distinct(F.array(_cell(first, F.col("_level")), _cell(last, F.col("_level")))))
    placed = placed.withColumn("_cell", F.explode(cells)).withColumn("_level", F.coalesce("_level", F.lit(1 << 20)))

    # one entry per length's power of two, and a copy for each share of a group's values
    levels = placed.groupBy(*keys).agg(F.collect_set("_level").alias("_levels")).withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(_SHARES - 1))))
    asked = df.filter(F.col(value).isNotNull()).select(*[F.col(k).alias(a) for k, a in zip(by, keys, strict=True)], F.col(value).alias("_value")).distinct()
    asked = asked.withColumn("_share", F.pmod(F.hash("_value"), F.lit(_SHARES)))
    asked = lookup_join(asked, levels, ["_share", *keys], "inner").withColumn("_level", F.explode("_levels")).drop("_levels", "_share")
    number = _as_number(F.col("_value"), df.schema[value].dataType)
    asked = asked.withColumn("_cell", F.when(F.col("_level") == 1 << 20, F.lit(0.0)).otherwise(_cell(number, F.col("_level"))))
    met = asked.join(placed, [*keys, "_level", "_cell"], "inner")
    above = F.col("_value") >= F.col("_low") if ends[0] == "[" else F.col("_value") > F.col("_low")
    below = F.col("_value") <= F.col("_high") if ends[1] == "]" else F.col("_value") < F.col("_high")
    met = met.filter(F.coalesce(above, F.lit(True)) & F.coalesce(below, F.lit(True)))
    hits = met.groupBy(*keys, "_value").agg(F.collect_list("_found").alias("_hits"))
    if overlaps == "refuse":
        both = F.concat(F.lit(f"intervals overlap at {value} "), F.col("_value").cast("string"))
        hits = hits.withColumn("_hits", F.when(F.size("_hits") > 1, F.raise_error(both)).otherwise(F.col("_hits")))
    hits = hits.select(*[F.col(a).alias(k) for a, k in zip(keys, by, strict=True)], F.col("_value").alias(value), "_hits")
    kept = [c for c in df.columns if c not in columns]
    out = lookup_join(df.select(*kept), hits, [*by, value]).withColumn("_hit", F.explode_outer("_hits"))
    return out.select(*kept, *[F.col(f"_hit.{c}").alias(c) for c in columns])


def visit_of_day_table(df: DataFrame, windows: DataFrame, day: str = "ADY", by: Sequence[str] = ()) -> DataFrame:
    """``visit_of_day`` with the windows as rows: AVISIT, AVISITN, AWRANGE, AWTARGET, AWLO, AWHI and, if they differ, keys ``by``."""
    named = ("AVISIT", "AVISITN", "AWRANGE", "AWTARGET", "AWLO", "AWHI")
    return interval_lookup(df, day, windows, "AWLO", "AWHI", named, by)
