"""Subject-level derivations: treatment, exposure, populations, disposition, sites."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subjectflow.functions.cells import case_chain, if_else, is_in, round_half_up, safe_ratio, sum_or_null
from subjectflow.functions.dates import duration
from subjectflow.operators.joins import lookup_join


def treatment_vars(df: DataFrame, arm: str, codes: Mapping[str, int], planned: str = "TRT01P", actual: str = "TRT01A") -> DataFrame:
    """Planned treatment with its code; the actual treatment is taken to be the planned one."""
    number = F
    for label, code in codes.items():
        number = number.when(F.col(arm) == label, F.lit(code))
    return df.withColumns({planned: F.col(arm), f"{planned}N": number, actual: F.col(arm), f"{actual}N": number})


def dose_summary(
    ex: DataFrame, by: Sequence[str], start: str, end: str, dose: str, valid: Column,
    names: tuple[str, str, str, str, str] = ("trtsdt", "trtedt", "trtdurd", "cumdose", "avgdd"), carry: Sequence[str] = (),
) -> DataFrame:
    """First/last valid dosing date, duration, cumulative and average daily dose per subject.

    One aggregate: the first start and last end date need no row, only the extreme date.
    The cumulative dose is null as soon as one record's dose is unknown. ``carry`` columns
    are equal on all records of a subject and come along.
    """
    first, last, days, total, average = names
    amount = F.col(dose) * (F.datediff(end, start) + 1)
    summed = ex.groupBy(*by).agg(
        F.min(F.when(valid, F.col(start))).alias(first),
        F.max(F.when(valid, F.col(end))).alias(last),
        sum_or_null(amount).alias(total),
        *[F.any_value(c).alias(c) for c in carry],
    )
    summed = summed.withColumn(days, duration(first, last))
    return summed.withColumn(average, round_half_up(safe_ratio(total, days), 1))


def characteristic(df: DataFrame, by: Sequence[str], test: str, code: str, value: str, name: str) -> DataFrame:
    """One characteristic of each subject: the largest value of the rows of one test."""
    return df.filter(F.col(test) == code).groupBy(*by).agg(F.max(value).alias(name))


def population_flag_vars(
    df: DataFrame, armcd: str, start: str, tests: str, needed: int = 2, failure: str = "Scrnfail",
    names: tuple[str, str, str] = ("saffl", "ittfl", "efffl"),
) -> DataFrame:
    """Safety, intent-to-treat and efficacy flags: Y, N, or null for screen failures."""
    randomised = (F.col(armcd) != failure) & (F.col(armcd) != "")
    treated = randomised & F.col(start).isNotNull()
    evaluable = treated & (F.col(tests) == needed)
    failed = F.col(armcd) == failure

    def yes_no(test: Column) -> Column:
        return case_chain([(test, F.lit("Y")), (failed, F.lit(None).cast("string"))], F.lit("N"))

    return df.withColumns(dict(zip(names, (yes_no(treated), yes_no(randomised), yes_no(evaluable)))))


def visit_flags(df: DataFrame, by: Sequence[str], visit: str, flags: Mapping[str, str]) -> DataFrame:
    """Y/N per expected visit for every subject that has any visit record."""
    cells = [F.max(F.when(F.col(visit) == label, "Y").otherwise("N")).alias(name) for name, label in flags.items()]
    return df.groupBy(*by).agg(*cells)


def disposition_vars(
    df: DataFrame, decode: str, end_date: str, term: str, reasons: Mapping[str, str], override: Column, override_text: str,
    completed: str = "COMPLETED", adverse: str = "ADVERSE EVENT",
    names: tuple[str, str, str, str] = ("eosstt", "disconfl", "dsraefl", "dcsreas"),
) -> DataFrame:
    """Status, discontinuation flag, adverse-event flag and reason from one disposition row."""
    status, discontinued, adverse_flag, reason = names
    done = F.col(decode) == completed
    text = F
    for code, label in reasons.items():
        text = text.when(F.col(decode) == code, F.lit(label))
    return df.withColumns({
        status: if_else(done, F.lit(completed), F.lit("DISCONTINUED")),
        discontinued: F.when(F.col(end_date).isNotNull() & ~done, "Y"),
        adverse_flag: F.when(F.col(term) == adverse, "Y"),
        reason: case_chain([(~done & override, F.lit(override_text)), (~done, text)], F.lit("")),
    })


def site_group(site: str | Column, pooled: Sequence[str], group: str = "900") -> Column:
    """Pooled site group from a fixed list of sites."""
    c = F.col(site) if isinstance(site, str) else site
    return F.when(is_in(c, pooled), F.lit(group)).otherwise(c)


def pool_small_sites(
    df: DataFrame, site: str, arm: str, arms: Sequence[str], target: str, smallest: int = 3, group: str = "900"
) -> DataFrame:
    """Pool every site that has fewer than ``smallest`` rows in any arm."""
    counts = [F.count_if(F.col(arm) == a) for a in arms]
    least = F.least(*counts) if len(counts) > 1 else counts[0]
    sizes = df.groupBy(site).agg(least.alias("_least"))
    text = F.when(F.col("_least") < smallest, F.lit(group)).otherwise(F.col(site).cast("string"))
    return lookup_join(df, sizes, [site]).withColumn(target, text).drop("_least")
