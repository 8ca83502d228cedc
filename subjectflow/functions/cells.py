"""Column functions: null rules, text and number cleaning, rounding.

Everything here is a plain Catalyst expression, so it stays inside whole-stage
code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- null rules
def if_else(test: Column, yes, no) -> Column:
    """Binary conditional whose result is null when the test is null."""
    return F.when(test, yes).when(~test, no)


def case_chain(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """First matching branch; a null test counts as no match."""
    chain = F
    for test, value in branches:
        chain = chain.when(test, value)
    return chain.otherwise(default)


def flag(test: Column) -> Column:
    """'Y' where the test holds, else null."""
    return F.when(test, F.lit("Y"))


def is_in(c: str | Column, values: Sequence) -> Column:
    """Set membership where null is never a member (so it negates safely)."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def sum_or_null(c: str | Column) -> Column:
    """Sum that is null as soon as one input is null."""
    c = col(c)
    return F.when(F.count_if(c.isNull()) == 0, F.sum(c))


def mean_or_null(c: str | Column) -> Column:
    """Mean that is null as soon as one input is null."""
    c = col(c)
    return F.when(F.count_if(c.isNull()) == 0, F.avg(c))


def sum_or_zero(c: str | Column) -> Column:
    """Sum over the non-null inputs; zero when there is none."""
    return F.coalesce(F.sum(col(c)), F.lit(0.0))


def n_distinct(c: str | Column) -> Column:
    """Distinct values, null counted as a value."""
    c = col(c)
    return F.count_distinct(c) + F.max(c.isNull().cast("int"))


def _over_strings(df: DataFrame, change) -> DataFrame:
    cells = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            cells.append(change(F.col(f"`{field.name}`")).alias(field.name, metadata=field.metadata))
        else:
            cells.append(F.col(f"`{field.name}`"))
    return df.select(cells)


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty text becomes null in every text column."""
    return _over_strings(df, lambda c: F.nullif(c, F.lit("")))


def nulls_to_blank(df: DataFrame) -> DataFrame:
    """Null becomes empty text in every text column."""
    return _over_strings(df, lambda c: F.coalesce(c, F.lit("")))


def fill_prefix(df: DataFrame, prefix: str, value: str = "") -> DataFrame:
    """Null becomes ``value`` in every text column whose name starts with ``prefix``."""
    names = [c for c in df.columns if c.startswith(prefix)]
    return df.fillna(value, subset=names) if names else df


# ------------------------------------------------------------ text and numbers
def to_number(c: str | Column) -> Column:
    """Text to double; text that is no number gives null."""
    return col(c).try_cast("double")


def digits_to_number(c: str | Column) -> Column:
    """Keep the digits only, then read them as a number."""
    return F.regexp_replace(col(c), "[^0-9]", "").try_cast("double")


def sentence_case(c: str | Column) -> Column:
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def title_case(c: str | Column) -> Column:
    """Capitalise the first letter after every word break (blank, dash, bracket...)."""
    words = F.split(F.lower(col(c)), r"(?<=[^\p{L}\p{N}'’.:_])")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), ""
    )


def paste(*parts, sep: str = "") -> Column:
    """Concatenate; a missing part prints as ``NA``."""
    texts = [F.coalesce(col(p).cast("string"), F.lit("NA")) for p in parts]
    return F.concat_ws(sep, *texts)


def _padded(c: Column, width: int, pad: str, fn) -> Column:
    return F.when(F.length(c) >= width, c).otherwise(fn(c, width, pad))


def pad_left(c: str | Column, width: int, pad: str = " ") -> Column:
    """Pad on the left; longer text is kept whole."""
    return _padded(col(c).cast("string"), width, pad, F.lpad)


def pad_right(c: str | Column, width: int, pad: str = " ") -> Column:
    """Pad on the right; longer text is kept whole."""
    return _padded(col(c).cast("string"), width, pad, F.rpad)


def contains_any(c: str | Column, texts: Sequence[str]) -> Column:
    """True when the text contains one of ``texts``."""
    c = col(c)
    test = c.contains(texts[0])
    for text in texts[1:]:
        test = test | c.contains(text)
    return test


# ------------------------------------------------------------------- rounding
_HALF_SLACK = 0.5 + 2.0**-26  # one half plus the square root of the double epsilon


def round_half_up(c: str | Column, digits: int = 0) -> Column:
    """Round half away from zero, with slack for decimals a double cannot hold.

    A value that has no fraction left at this scale (2^53 and above) and an infinite one
    are returned as they are.
    """
    c = col(c).cast("double")
    scale = F.lit(float(10**digits))
    whole = F.abs(c) * scale >= F.lit(2.0**53)
    return F.when(whole | F.isnan(c), c).otherwise(F.signum(c) * F.floor(F.abs(c) * scale + F.lit(_HALF_SLACK)) / scale)


def half_even_units(c: str | Column, digits: int) -> Column:
    """``c * 10^digits`` rounded to a whole number by the exact binary value.

    The rounding error of the product is recovered with a split multiplication, so
    a value such as 0.15 (slightly below its decimal text) rounds down, and a true
    tie goes to the even digit.
    """
    x = col(c).cast("double")
    scale = float(10**digits)
    splitter = float(2**27 + 1)
    s_hi = scale * splitter - (scale * splitter - scale)
    s_lo = scale - s_hi
    p = x * F.lit(scale)
    t = x * F.lit(splitter)
    x_hi = t - (t - x)
    x_lo = x - x_hi
    err = ((x_hi * s_hi - p) + x_hi * s_lo + x_lo * s_hi) + x_lo * s_lo
    near = F.rint(p)
    off = p - near
    return F.when((off == 0.5) & (err > 0), near + 1).when((off == -0.5) & (err < 0), near - 1).otherwise(near)


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    """Round to the nearest decimal, exact ties to the even digit."""
    return half_even_units(c, digits) / F.lit(float(10**digits))


def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """Quotient that is null for a zero divisor."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def clean_precision(c: str | Column, significant: int = 7) -> Column:
    """Where the number prints three or more decimals, keep ``significant`` digits."""
    x = col(c).cast("double")
    text = x.cast("string")
    magnitude = F.floor(F.log10(F.abs(x))) + 1
    places = F.greatest(F.lit(significant) - magnitude, F.lit(0))
    scale = F.pow(F.lit(10.0), places)
    rounded = F.when(F.abs(x) * scale >= F.lit(2.0**53), x).otherwise(F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale)
    return F.when(text.rlike(r"\.[0-9]{3,}(E.*)?$") & (x != 0), rounded).otherwise(x)
