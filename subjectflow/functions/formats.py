"""Numbers to report text. All functions return Catalyst expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from subjectflow.functions.cells import col, half_even_units, pad_right


def fixed(c: str | Column, digits: int, width: int = 0, signed_zero: bool = True) -> Column:
    """Text with exactly ``digits`` decimals, rounded by the exact binary value.

    Shorter text is padded on the left to ``width``; null stays null. With
    ``signed_zero`` a negative number that rounds to zero keeps its sign.
    """
    x = col(c).cast("double")
    units = half_even_units(x, digits)
    value = (units if signed_zero else units + F.lit(0.0)) / F.lit(float(10**digits))
    mask = f"%{width}.{digits}f" if width else f"%.{digits}f"
    return F.when(x.isNotNull(), F.format_string(mask, value))


def fmt_num(c: str | Column, digits: int, width: int | None = None) -> Column:
    """Right-aligned fixed-width decimal text; width defaults to ``digits + 4``."""
    return fixed(c, digits, digits + 4 if width is None else width)


def fmt_est(mean: str | Column, sd: str | Column, digits: tuple[int, int] = (1, 2)) -> Column:
    """``mean (sd)`` with aligned widths."""
    return F.concat(
        fmt_num(mean, digits[0], digits[0] + 4),
        F.lit(" ("),
        fmt_num(sd, digits[1], digits[1] + 3),
        F.lit(")"),
    )


def fmt_ci(est, lower, upper, digits: int = 2, width: int | None = None) -> Column:
    """``estimate (lower,upper)`` with aligned widths."""
    w = digits + 3 if width is None else width
    return F.concat(
        fmt_num(est, digits, w), F.lit(" ("), fmt_num(lower, digits, w), F.lit(","), fmt_num(upper, digits, w), F.lit(")")
    )


def fmt_pval(p: str | Column, digits: int = 3) -> Column:
    """p-value text; values below the resolution print as ``<0.001``."""
    floor = 10.0**-digits
    return F.when(col(p) < F.lit(floor), F.lit(f"<{floor:.{digits}f}")).otherwise(fmt_num(p, digits))


def num_fmt(c: str | Column, digits: int = 0, size: int = 10, int_len: int = 3) -> Column:
    """Rounded number aligned on the decimal point and padded to ``size``; null prints blank."""
    width = int_len + (digits + 1 if digits > 0 else 0)
    return F.when(col(c).isNull(), F.lit("")).otherwise(pad_right(fixed(c, digits, width, signed_zero=False), size))


def masked(mask: str, *values: str | Column, align: bool = True) -> Column:
    """Fill the ``xx.x`` fields of ``mask`` in order.

    Each field fixes the decimals; with ``align`` it also fixes the minimum width.
    The result is blank when a value is missing.
    """
    pieces: list[Column] = []
    left: Sequence = list(values)
    position = 0
    missing = F.lit(False)
    for match in re.finditer(r"x+(?:\.(x+))?", mask):
        if match.start() > position:
            pieces.append(F.lit(mask[position : match.start()]))
        value, left = left[0], left[1:]
        pieces.append(fixed(value, len(match.group(1) or ""), len(match.group(0)) if align else 0, False))
        missing = missing | col(value).isNull()
        position = match.end()
    if position < len(mask):
        pieces.append(F.lit(mask[position:]))
    return F.when(missing, F.lit("")).otherwise(F.concat(*pieces))
