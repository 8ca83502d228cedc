"""Per-subject, per-parameter derivations over time.

Baselines, carried values and end-of-treatment records come from partial
aggregates joined back to the rows. Where expected visits are a short list, a carried value
needs one slot per visit, not an ordered group; where they are a table, a scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subjectflow.functions.cells import case_chain, digits_to_number, if_else, safe_ratio, sentence_case
from subjectflow.operators.joins import lookup_join
from subjectflow.operators.picks import flag_extreme, pick_row
from subjectflow.operators.ranges import interval_lookup
from subjectflow.operators.scans import scan


def baseline(
    df: DataFrame, by: Sequence[str], source: str, target: str, flag: str = "ABLFL", check: bool = True
) -> DataFrame:
    """Value of the group's baseline-flagged row on every row of the group."""
    value = F.max(source)
    if check:
        value = F.when(F.count("*") == 1, value).otherwise(F.raise_error(F.lit("more than one baseline record in a group")))
    base = df.filter(F.col(flag) == "Y").groupBy(*by).agg(value.alias(target))
    return lookup_join(df, base, by)


def baseline_record(
    df: DataFrame, by: Sequence[str], order: Sequence[str], row_key: Sequence[str], values: Mapping[str, str],
    flag: str = "ABLFL", mode: str = "last", where: Column | None = None,
) -> DataFrame:
    """Choose the baseline record and put its values on every row, in one join.

    The first/last row in ``order`` among those meeting ``where`` is the baseline record
    of its group: it gets 'Y' in ``flag``, and all rows get its ``values`` (new name ->
    column). Flagging first and looking the flagged value up afterwards would move the
    rows twice.
    """
    pool = df if where is None else df.filter(where)
    needed = list(dict.fromkeys([*by, *row_key, *order, *values.values()]))
    chosen = pick_row(pool.select(*needed), by, [*order, *row_key], mode).select(
        *by, *[F.col(k).alias(f"_r_{k}") for k in row_key], *[F.col(old).alias(new) for new, old in values.items()]
    )
    same = None
    for k in row_key:
        part = F.col(k) == F.col(f"_r_{k}")
        same = part if same is None else same & part
    out = lookup_join(df, chosen, by)
    return out.withColumn(flag, F.when(same, F.lit("Y"))).drop(*[f"_r_{k}" for k in row_key])


def change(value: str = "AVAL", base: str = "BASE") -> Column:
    return F.col(value) - F.col(base)


def percent_change(value: str = "AVAL", base: str = "BASE") -> Column:
    """100 * (value - base) / |base|; null for a zero base."""
    return F.lit(100.0) * safe_ratio(F.col(value) - F.col(base), F.abs(F.col(base)))


def flag_closest(
    df: DataFrame, by: Sequence[str], row_key: Sequence[str], name: str = "ANL01FL", day: str = "ADY",
    target: str = "AWTARGET", where: Column | None = None,
) -> DataFrame:
    """Flag the record closest to the target day; on a tie the later day wins."""
    return flag_extreme(_distance(df, day, target), by, ["_off", "_gap"], row_key, name, where=where).drop("_off", "_gap")


def closest_records(
    df: DataFrame, by: Sequence[str], row_key: Sequence[str], day: str = "ADY", target: str = "AWTARGET", where: Column | None = None
) -> DataFrame:
    """Only the records ``flag_closest`` would flag."""
    pool = df if where is None else df.filter(where)
    return pick_row(_distance(pool, day, target), by, ["_off", "_gap", *row_key]).drop("_off", "_gap")


def _distance(df: DataFrame, day: str, target: str) -> DataFrame:
    gap = F.col(target) - F.col(day)
    return df.withColumns({"_off": F.abs(gap), "_gap": gap})


def locf(
    df: DataFrame, by: Sequence[str], expected: Sequence[tuple[int, str]], keep: Sequence[str], row_key: Sequence[str],
    visit_number: str = "AVISITN", visit: str = "AVISIT", value: str = "AVAL", where: Column | None = None,
    constant: Sequence[str] = (), pool: DataFrame | None = None,
) -> DataFrame:
    """Add a record for every missing expected visit, carrying the last earlier value.

    One aggregate per group holds, for each expected visit, whether it was observed and
    the latest observed record up to it. A visit with no earlier value adds nothing.
    Added rows carry ``keep`` columns of the record they come from, the ``constant``
    columns (equal on all rows of a group) and DTYPE ``LOCF``. ``pool`` gives the records
    to carry from when they are already at hand; else they are the rows meeting ``where``.
    """
    pool = (df if pool is None else pool).filter(F.col(value).isNotNull())
    if where is not None:
        pool = pool.filter(where)
    carried = F.struct(F.col(visit_number).alias("_n"), *[F.col(k).alias(f"_k_{k}") for k in row_key],
                       F.col(value).alias("_v"), *[F.col(k).alias(f"_c_{k}") for k in keep])
    slots = []
    for i, (number, _) in enumerate(expected):
        slots.append(F.max(F.when(F.col(visit_number) == number, F.lit(1))).alias(f"_seen{i}"))
        slots.append(F.max(F.when(F.col(visit_number) <= number, carried)).alias(f"_last{i}"))
    grouped = pool.groupBy(*by).agg(*slots, *[F.any_value(c).alias(c) for c in constant])
    gaps = F.array(
        *[
            F.when(
                F.col(f"_seen{i}").isNull() & F.col(f"_last{i}").isNotNull(),
                F.struct(F.lit(number).alias("number"), F.lit(label).alias("label"), F.col(f"_last{i}").alias("last")),
            )
            for i, (number, label) in enumerate(expected)
        ]
    )
    added = grouped.select(*by, *constant, F.explode(gaps).alias("_g")).filter(F.col("_g").isNotNull())
    added = added.select(
        *by,
        *constant,
        F.col("_g.number").cast(df.schema[visit_number].dataType).alias(visit_number),
        F.col("_g.label").alias(visit),
        F.col("_g.last._v").alias(value),
        *[F.col(f"_g.last._c_{k}").alias(k) for k in keep],
        F.lit("LOCF").alias("DTYPE"),
    )
    observed = df if "DTYPE" in df.columns else df.withColumn("DTYPE", F.lit(None).cast("string"))
    return observed.unionByName(added, allowMissingColumns=True)


#: Visits of a group that one task orders.
_VISITS = 1_024


def locf_table(
    df: DataFrame, by: Sequence[str], visits: DataFrame, keep: Sequence[str], row_key: Sequence[str], visit_number: str = "AVISITN",
    visit: str | None = "AVISIT", value: str = "AVAL", where: Column | None = None, visit_by: Sequence[str] = (),
) -> DataFrame:
    """``locf`` for expected visits that are rows of a table: any number of them, and different ones by ``visit_by``.

    ``visits`` holds ``visit_number`` (once per ``visit_by``, which is part of ``by``) and, unless
    ``visit`` is None, its label. Records fall between two expected visits, and of those only the
    latest is kept, so a group has no more rows than visits. Each row learns the next one of
    its group by a scan over chunks of the visits, and fills those between. Added rows carry
    ``keep`` columns of the record they come from and DTYPE ``LOCF``.
    """
    by, visit_by, labels = list(by), list(visit_by), [visit] if visit else []
    one = [F.lit(0).alias("_one")] if not visit_by else []
    place = Window.partitionBy(*(visit_by or ["_one"])).orderBy(visit_number)
    listed = visits.select(*visit_by, visit_number, *labels, *one)
    listed = listed.select(*visit_by, visit_number, *labels, F.row_number().over(place).alias("_i"), F.lead(visit_number).over(place).alias("_next"))
    pool = df.filter(F.col(value).isNotNull() & F.col(visit_number).isNotNull())
    if where is not None:
        pool = pool.filter(where)
    record = F.struct(F.col(visit_number).alias("_n"), *[F.col(k).alias(f"_k_{k}") for k in row_key], F.col(value).alias("_v"), *[F.col(k).alias(f"_c_{k}") for k in keep])
    pool = pool.select(*by, F.col(visit_number).alias("_at"), record.alias("_r"))
    starts = listed.select(*visit_by, F.col(visit_number).alias("_low"), F.col("_next").alias("_high"), "_i", F.col(visit_number).alias("_own"))
    placed = interval_lookup(pool, "_at", starts, "_low", "_high", ["_i", "_own"], visit_by, ends="[)")
    rows = placed.groupBy(*by, F.coalesce("_i", F.lit(0)).alias("_i")).agg(F.max("_r").alias("_r"), F.max(F.coalesce((F.col("_at") == F.col("_own")).cast("int"), F.lit(0))).alias("_seen"))
    rows = rows.withColumn("_chunk", F.floor(F.col("_i") / _VISITS))
    rows = scan(rows, by, "_chunk", ["_i"], {"_then": ("min", F.struct("_i", "_seen"))}, backwards=True, exclusive=True)
    whole = listed.groupBy(*visit_by).agg(F.max("_i").alias("_all"))
    # a group's last row fills all that is left; the total goes to each row by its keys
    rows = rows.withColumn("_share", F.pmod(F.hash("_i", *by), F.lit(16)))
    whole = whole.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(15))))
    rows = lookup_join(rows, whole, ["_share", *visit_by], "inner")
    end = F.when(F.col("_then").isNull(), F.col("_all")).otherwise(F.col("_then._i") - F.col("_then._seen"))
    filled = rows.filter(end > F.col("_i")).select(*by, "_r", F.explode(F.sequence(F.col("_i") + 1, end)).alias("_i"))
    added = lookup_join(filled, listed.drop("_next"), [*visit_by, "_i"], "inner").select(
        *by, F.col(visit_number).cast(df.schema[visit_number].dataType).alias(visit_number), *labels, F.col("_r._v").alias(value),
        *[F.col(f"_r._c_{k}").alias(k) for k in keep], F.lit("LOCF").alias("DTYPE"),
    )
    observed = df if "DTYPE" in df.columns else df.withColumn("DTYPE", F.lit(None).cast("string"))
    return observed.unionByName(added, allowMissingColumns=True)


def name_visits(df: DataFrame, visit: str = "VISIT", flag: str = "ABLFL") -> DataFrame:
    """AVISIT and AVISITN: the baseline record is Baseline/0, unscheduled is blank, else
    the sentence-case visit name and the digits in it."""
    label = case_chain(
        [(F.col(flag) == "Y", F.lit("Baseline")), (F.col(visit).contains("UNSCHEDULED"), F.lit(""))],
        sentence_case(visit),
    )
    number = F.when(F.col("AVISIT") == "Baseline", F.lit(0.0)).otherwise(digits_to_number("AVISIT"))
    return df.withColumn("AVISIT", label).withColumn("AVISITN", number)


def end_of_treatment(
    df: DataFrame, by: Sequence[str], row_key: Sequence[str], endpoint: Column, last_visit: Column, after: Column,
    label: str = "End of Treatment", number: float = 99.0, kept: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Visit rows with visit-99 copies, and the fallback copies on their own.

    Rows flagged as ``endpoint`` or at the ``last_visit`` are copied as visit 99 (from
    all rows; ``kept`` then restricts the rows that stay as visits). A group whose
    highest visit, not counting rows ``after`` treatment, is a real post-baseline visit
    and not yet 99 has that row copied in the second frame.
    """
    stamp = {"AVISIT": F.lit(label), "AVISITN": F.lit(number).cast(df.schema["AVISITN"].dataType), "AENTMTFL": F.lit("Y")}
    copied = F.coalesce(endpoint | last_visit, F.lit(False))
    stays = F.lit(True) if kept is None else F.coalesce(kept, F.lit(False))
    # a row and its copy in one pass over the rows
    visit = F.struct(F.col("AVISIT"), F.col("AVISITN"), F.lit("").alias("AENTMTFL"))
    copy = F.struct(*[c.alias(n) for n, c in stamp.items()])
    unfolded = df.withColumn("_e", F.explode(F.array_compact(F.array(F.when(stays, visit), F.when(copied, copy)))))
    both = unfolded.select(*[F.col(f"_e.{c}").alias(c) if c in stamp else F.col(c) for c in dict.fromkeys([*df.columns, *stamp])])
    top = pick_row(both.filter(~after), by, ["-AVISITN", *row_key])
    fallback = top.filter(F.col("AVISITN").isNotNull() & ~F.col("AVISITN").isin(0.0, number)).withColumns(stamp)
    return both, fallback


def text_result(value: str, text: str) -> Column:
    """Text form of a result, kept only where there is a number."""
    return F.when(F.col(value).isNotNull(), F.col(text))


def limit_ratios(df: DataFrame, low: str = "LBSTNRLO", high: str = "LBSTNRHI") -> DataFrame:
    """Normal-range limits and the ratios of value and baseline to them."""
    return df.withColumns({
        "ANRLO": F.col(low),
        "ANRHI": F.col(high),
        "A1LO": F.col(low),
        "A1HI": F.col(high),
        "R2A1LO": safe_ratio("AVAL", low),
        "R2A1HI": safe_ratio("AVAL", high),
        "BR2A1LO": safe_ratio("BASE", low),
        "BR2A1HI": safe_ratio("BASE", high),
    })


def threshold_distance(value: str, low: str, high: str) -> Column:
    """Larger distance to 1.5 x upper or 0.5 x lower limit; null if either is null."""
    over = F.abs(F.col(value) - F.lit(1.5) * F.col(high))
    under = F.abs(F.lit(0.5) * F.col(low) - F.col(value))
    return if_else(over > under, over, under)


def range_indicator(value: str = "AVAL", low: str = "LBSTNRLO", high: str = "LBSTNRHI") -> Column:
    """L / N / H against 0.5 x lower and 1.5 x upper limit.

    A missing value counts as N; a missing limit gives null.
    """
    v, lo, hi = F.col(value), F.lit(0.5) * F.col(low), F.lit(1.5) * F.col(high)
    return F.when(v.isNull(), F.lit("N")).otherwise(if_else(v < lo, F.lit("L"), if_else(v > hi, F.lit("H"), F.lit("N"))))


def flag_furthest(
    df: DataFrame, by: Sequence[str], value: str, row_key: Sequence[str], name: str = "ANL01FL", where: Column | None = None
) -> DataFrame:
    """Flag, on every copy of it, the record with the largest ``value`` in each group.

    ``where`` restricts the records that compete. A group without any value gets no flag.
    """
    pool = (df if where is None else df.filter(where)).select(*by, *[k for k in row_key if k not in by], value)
    chosen = pick_row(pool, by, [f"-{value}", *row_key])
    marks = chosen.select(*row_key, F.when(F.col(value).isNotNull(), F.lit("Y")).alias(name))
    return df.join(marks, list(row_key), "left")


def flag_latest_visit(
    df: DataFrame, by: Sequence[str], row_key: Sequence[str], where: Column, name: str, visit_number: str = "AVISITN"
) -> DataFrame:
    """'Y' on rows whose record is the group's highest visit among ``where``, '' on the
    other records meeting ``where``, null elsewhere; every copy of a record is stamped."""
    pool = df.filter(where)
    best = pool.groupBy(*by).agg(F.max(visit_number).alias("_top"))
    marks = (
        lookup_join(pool.select(*dict.fromkeys([*by, *row_key]), visit_number), best, by)
        .select(*row_key, F.when(F.col(visit_number) == F.col("_top"), F.lit("Y")).otherwise(F.lit("")).alias(name))
        .groupBy(*row_key)
        .agg(F.max(name).alias(name))
    )
    return df.join(marks, list(row_key), "left")

