"""ISO text to dates with imputation, study days and durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from subjectflow.functions.cells import col

# What may be filled in, from least to most.
_LEVELS = {"n": 0, "h": 0, "D": 1, "M": 2, "Y": 3}


def _shape(c: Column) -> Column:
    """The text with every digit as 0: cheaper to test than a regular expression."""
    return F.translate(c, "0123456789", "0000000000")


def _ends(shape: Column, at: int) -> Column:
    """Nothing but a missing part or a time follows from position ``at``."""
    return F.substring(shape, at, 1).isin("", "T") | F.substring(shape, at, 2).isin("-", "--")


def parse_iso_date(c: str | Column) -> Column:
    """Date of a complete ISO date or datetime text; anything partial is null."""
    c = col(c)
    shape = _shape(c)
    full = (F.substring(shape, 1, 10) == "0000-00-00") & F.substring(shape, 11, 1).isin("", "T")
    return F.when(full, F.substring(c, 1, 10).try_cast("date"))


def _date_of(*parts) -> Column:
    return F.concat_ws("-", *parts).try_cast("date")


def impute_date(
    c: str | Column,
    highest: str = "n",
    how: str = "first",
    max_dates: Sequence[str | Column] = (),
    min_dates: Sequence[str | Column] = (),
) -> Column:
    """ISO text, possibly partial, to a date.

    ``highest`` is the largest part that may be filled: ``n`` none, ``D`` day, ``M``
    month, ``Y`` year. ``how`` is ``first``, ``mid`` or ``last``. An imputed date is
    pulled inside ``min_dates``/``max_dates`` as far as the partial text allows; with
    ``Y`` a missing text takes the bound itself. Complete dates are never changed.
    """
    c = col(c)
    level = _LEVELS[highest]
    shape = _shape(c)
    has_day = (F.substring(shape, 1, 10) == "0000-00-00") & F.substring(shape, 11, 1).isin("", "T")
    has_month = (F.substring(shape, 1, 7) == "0000-00") & _ends(shape, 8)
    only_year = (F.substring(shape, 1, 4) == "0000") & _ends(shape, 5)

    full = F.substring(c, 1, 10).try_cast("date")
    year, month = F.substring(c, 1, 4), F.substring(c, 1, 7)
    month_lo = _date_of(month, F.lit("01"))
    month_hi = F.last_day(month_lo)
    year_lo = _date_of(year, F.lit("01"), F.lit("01"))
    year_hi = _date_of(year, F.lit("12"), F.lit("31"))

    def pick(lo: Column, hi: Column, mid: Column) -> Column:
        value = {"first": lo, "last": hi, "mid": mid}[how]
        for bound in max_dates:
            b = col(bound)
            value = F.when((b >= lo) & (b < value), b).otherwise(value)
        for bound in min_dates:
            b = col(bound)
            value = F.when((b <= hi) & (b > value), b).otherwise(value)
        return value

    out = F.when(has_day, full)
    if level >= 1:
        out = out.when(has_month, pick(month_lo, month_hi, F.date_add(month_lo, 14)))
    if level >= 2:
        out = out.when(only_year, pick(year_lo, year_hi, _date_of(year, F.lit("06"), F.lit("30"))))
    if level >= 3:
        bounds = [col(b) for b in (max_dates if how == "last" else min_dates)]
        if bounds:
            edge = bounds[0]
            if len(bounds) > 1:
                edge = (F.least if how == "last" else F.greatest)(*bounds)
            out = out.when(c.isNull() | (c == ""), edge)
    return out


def impute_datetime(c: str | Column, highest: str = "h", how: str = "first", **bounds) -> Column:
    """ISO text to a datetime; a missing time becomes the start (or end) of the day.

    ``highest`` ``h`` fills the time only, ``D``/``M`` also the date parts, ``n`` nothing.
    """
    c = col(c)
    day = impute_date(c, highest, how, **bounds)
    fills = ("00", "00", "00") if how == "first" else ("23", "59", "59")
    # Two-digit time parts sit at fixed places after the date's T.
    clock = F.when(F.instr(c, "T") > 0, F.substring_index(c, "T", -1)).otherwise(F.lit(""))
    parts = []
    for start, fill in zip((1, 4, 7), fills):
        part = F.substring(clock, start, 2) if start < 7 else F.substr(clock, F.lit(7))
        parts.append(F.when(F.substring(_shape(part), 1, 2) == "00", part).otherwise(F.lit(fill)))
    stamp = F.concat(day.cast("string"), F.lit(" "), F.concat_ws(":", *parts)).try_cast("timestamp_ntz")
    if highest == "n":
        return F.when(c.rlike(r"T\d{2}:\d{2}:\d{2}"), stamp)
    return stamp


def date_imputed_flag(c: str | Column, imputed: Column) -> Column:
    """Largest imputed part of the date: ``D``, ``M``, ``Y`` or null."""
    c = col(c)
    return F.when(
        imputed.isNotNull(),
        F.when(parse_iso_date(c).isNotNull(), F.lit(None))
        .when(c.rlike(r"^\d{4}-\d{2}"), F.lit("D"))
        .when(c.rlike(r"^\d{4}"), F.lit("M"))
        .otherwise(F.lit("Y")),
    )


def study_day(date: str | Column, reference: str | Column) -> Column:
    """Day number against a reference day that is day 1; there is no day 0."""
    d, r = col(date).cast("date"), col(reference).cast("date")
    return F.datediff(d, r) + F.when(d >= r, 1).otherwise(0)


# Days per unit.
_DAYS_PER = {"days": 1.0, "weeks": 7.0, "months": 30.4375, "years": 365.25}


def duration(start, end, unit: str = "days", add_one: bool = True) -> Column:
    """Elapsed time from start to end, both ends counted when ``add_one``."""
    s, e = col(start).cast("date"), col(end).cast("date")
    days = F.datediff(e, s)
    if add_one:
        days = days + F.when(days >= 0, 1).otherwise(0)
    per = _DAYS_PER[unit.lower()]
    return days if per == 1.0 else days / F.lit(per)


def duration_unit(value: str | Column, unit: str) -> Column:
    """The unit text, only where there is a duration."""
    return F.when(col(value).isNotNull(), F.lit(unit))
