"""The five analysis tables as Spark plans over tabulation tables.

Inputs are frames with the standard tabulation column names (DM, DS, EX, QS, SV, VS, SC,
MH, AE, LB, SUPPLB), blanks already read as null. Every side table is reduced to one row
per subject in one pass before it is joined, so each input is shuffled once. Code lists
that are not part of the programs come in as arguments.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subjectflow.functions import values
from subjectflow.functions.cells import case_chain, if_else, paste, round_half_up, safe_ratio, sum_or_zero, title_case, to_number
from subjectflow.functions.dates import duration, duration_unit, impute_date, impute_datetime, parse_iso_date, study_day
from subjectflow.operators import longitudinal, merges, occurrence, ranges, subject, survival
from subjectflow.operators.joins import lookup_join
from subjectflow.operators.spec import TableSpec, conform

SUBJECT = ["STUDYID", "USUBJID"]
PARAMETER = [*SUBJECT, "PARAMCD"]


def _finish(df: DataFrame, spec: TableSpec | None) -> DataFrame:
    return df if spec is None else conform(df, spec)


# ------------------------------------------------------------------- subject level
def disposition_events(ds: DataFrame) -> DataFrame:
    """One disposition row per subject with the end-of-study date."""
    kept = ds.filter((F.col("DSCAT") == "DISPOSITION EVENT") & (F.col("DSDECOD") != "SCREEN FAILURE"))
    return kept.select(*SUBJECT, impute_date("DSSTDTC", "n").alias("EOSDT"), F.col("DSDECOD").alias("DCDECOD"), "DSTERM")


def exposure_dates(ex: DataFrame, disposition: DataFrame) -> DataFrame:
    """Exposure rows with start and end dates; a missing end is the discontinuation date."""
    left = disposition.filter(F.col("DCDECOD") != "COMPLETED")
    dated = merges.merge_vars(ex, left, SUBJECT, ["EOSDT"])
    return dated.withColumns({
        "EXSTDT": impute_date("EXSTDTC", "n"),
        "EXENDT": impute_date("EXENDTC", "Y", "last", max_dates=["EOSDT"]),
    })


def visit_facts(sv: DataFrame) -> DataFrame:
    """Completion flags, first screening date and last scheduled visit, in one pass."""
    scheduled = F.when(
        F.col("VISITNUM") < 100,
        F.struct(F.col("SVSTDTC").isNull().alias("n"), F.col("SVSTDTC").alias("d"), F.col("VISITNUM").alias("v")),
    )
    flags = {"COMP8FL": "WEEK 8", "COMP16FL": "WEEK 16", "COMP24FL": "WEEK 24"}
    last = round_half_up(F.col("_last.v"))
    return (
        sv.groupBy(*SUBJECT)
        .agg(
            *[F.max(F.when(F.col("VISIT") == label, "Y").otherwise("N")).alias(name) for name, label in flags.items()],
            F.min(F.when(F.col("VISITNUM") == 1, parse_iso_date("SVSTDTC"))).alias("VISIT1DT"),
            F.max(scheduled).alias("_last"),
        )
        .withColumn("VISNUMEN", if_else(last == 13, F.lit(12.0), last))
        .drop("_last")
    )


def questionnaire_facts(qs: DataFrame) -> DataFrame:
    """Number of efficacy tests after visit 3 and the mini-mental total, in one pass."""
    late = F.col("VISITNUM") > 3

    def seen(test: str):
        return F.coalesce(F.max(F.when(late & (F.col("QSTESTCD") == test), 1)), F.lit(0))

    mental = F.col("QSCAT") == "MINI-MENTAL STATE"
    return qs.groupBy(*SUBJECT).agg(
        (seen("CIBIC") + seen("ACTOT")).alias("EFFCNT"),
        F.when(F.count_if(mental) > 0, sum_or_zero(F.when(mental, to_number("QSORRES")))).alias("MMSETOT"),
    )


def baseline_vitals(vs: DataFrame, bmi_groups: Sequence[str]) -> DataFrame:
    """Baseline height, weight, body mass index and its group."""
    def at(test: str, visit: int):
        return F.max(F.when((F.col("VSTESTCD") == test) & (F.col("VISITNUM") == visit), round_half_up("VSSTRESN", 1)))

    wide = vs.groupBy(*SUBJECT).agg(at("HEIGHT", 1).alias("HEIGHTBL"), at("WEIGHT", 3).alias("WEIGHTBL"))
    meters = F.col("HEIGHTBL") / 100.0
    wide = wide.withColumn("BMIBL", round_half_up(safe_ratio("WEIGHTBL", meters * meters), 1))
    return ranges.range_category(wide, "BMIBL", bmi_groups, "BMIBLGR1")


def subject_level(
    dm: DataFrame, ds: DataFrame, ex: DataFrame, qs: DataFrame, sv: DataFrame, vs: DataFrame, sc: DataFrame, mh: DataFrame,
    race_codes: Mapping[str, int] | None = None, reasons: Mapping[str, str] | None = None,
    bmi_groups: Sequence[str] = ("<25", "25-<30", ">=30"), disease_groups: Sequence[str] = ("<12", ">=12"),
    spec: TableSpec | None = None,
) -> DataFrame:
    """One row per randomised subject with treatment, populations, disposition, baseline."""
    disposition = disposition_events(ds)
    dosing = exposure_dates(ex, disposition)
    valid = (F.col("EXDOSE") > 0) | ((F.col("EXDOSE") == 0) & F.col("EXTRT").contains("PLACEBO"))
    doses = subject.dose_summary(
        dosing, SUBJECT, "EXSTDT", "EXENDT", "EXDOSE", valid, ("TRTSDT", "TRTEDT", "TRTDURD", "CUMDOSE", "AVGDD")
    )
    education = subject.characteristic(sc, SUBJECT, "SCTESTCD", "EDLEVEL", "SCSTRESN", "EDUCLVL")
    onset = mh.filter(F.col("MHCAT") == "PRIMARY DIAGNOSIS").groupBy(*SUBJECT).agg(F.min(parse_iso_date("MHSTDTC")).alias("DISONSDT"))

    out = dm.drop("DOMAIN").filter(F.col("ACTARMCD") != "Scrnfail")
    out = subject.treatment_vars(out, "ARM", values.ARM_CODES)
    out = ranges.range_category(out, "AGE", values.AGE_GROUPS, "AGEGR1", "AGEGR1N")
    if race_codes:
        out = merges.map_codelist(out, race_codes, "RACE", "RACEN")
    for side in (doses, questionnaire_facts(qs), visit_facts(sv), baseline_vitals(vs, bmi_groups), education, onset):
        out = out.join(side, SUBJECT, "left")
    out = merges.merge_vars(out, disposition, SUBJECT, ["EOSDT", "DCDECOD", "DSTERM"], one_to_one=True)
    out = subject.population_flag_vars(out, "ARMCD", "TRTSDT", "EFFCNT", names=("SAFFL", "ITTFL", "EFFFL"))
    out = subject.disposition_vars(
        out, "DCDECOD", "EOSDT", "DSTERM", reasons or {}, F.col("DSTERM") == "PROTOCOL ENTRY CRITERIA NOT MET", "I/E Not Met",
        names=("EOSSTT", "DISCONFL", "DSRAEFL", "DCSREAS"),
    )
    out = out.withColumns({
        "DURDIS": round_half_up(duration("DISONSDT", "VISIT1DT", "months"), 1),
        "RFENDT": parse_iso_date("RFENDTC"),
        "SITEGR1": subject.site_group("SITEID", values.POOLED_SITES, values.POOLED_SITE_GROUP),
    })
    out = ranges.range_category(out, "DURDIS", disease_groups, "DURDSGR1")
    return _finish(out.drop("EFFCNT"), spec)


# ------------------------------------------------------------------- adverse events
def adverse_events(ae: DataFrame, adsl: DataFrame, spec: TableSpec | None = None) -> DataFrame:
    """Events with dates, days, duration, emergent flag and first-occurrence flags."""
    carried = ["TRTSDT", "TRTEDT", "SITEID", "TRT01A", "TRT01AN", "AGE", "AGEGR1", "AGEGR1N", "RACE", "RACEN", "SEX", "SAFFL"]
    out = merges.merge_vars(ae, adsl, SUBJECT, [c for c in carried if c in adsl.columns])
    out = out.withColumnsRenamed({"TRT01A": "TRTA", "TRT01AN": "TRTAN"})
    out = out.withColumns({"ASTDTM": impute_datetime("AESTDTC", "D"), "AENDTM": impute_datetime("AEENDTC", "h")})
    out = out.withColumns({"ASTDT": F.col("ASTDTM").cast("date"), "AENDT": F.col("AENDTM").cast("date")})
    out = out.withColumns({
        "TRTSDY": study_day("TRTSDT", "TRTSDT"), "ASTDY": study_day("ASTDT", "TRTSDT"), "AENDY": study_day("AENDT", "TRTSDT"),
        "ADURN": duration("ASTDT", "AENDT"),
        "TRTEMFL": F.when(F.col("ASTDT").isNotNull(), occurrence.treatment_emergent("ASTDT", "AENDT", "TRTSDT")),
        "CQ01NAM": occurrence.custom_query(
            "AEDECOD", "AEBODSYS", values.CUSTOM_QUERY_TERMS, values.CUSTOM_QUERY_CLASS, values.CUSTOM_QUERY_EXCLUDED,
            values.CUSTOM_QUERY_NAME,
        ),
    })
    out = out.withColumn("ADURU", duration_unit("ADURN", "DAYS"))
    out = occurrence.occurrence_flags(
        out, "USUBJID", "AEBODSYS", "AEDECOD", "ASTDT", "AESEQ", F.col("TRTEMFL") == "Y", F.col("AESER") == "Y",
        F.col("CQ01NAM") == values.CUSTOM_QUERY_NAME,
    )
    return _finish(out, spec)


# ------------------------------------------------------------------- chemistry
def chemistry(
    lb: DataFrame, supplb: DataFrame, adsl: DataFrame, param_codes: Mapping[str, int] | None = None,
    supp_names: Sequence[str] = ("ENDPOINT",), spec: TableSpec | None = None,
) -> DataFrame:
    """Chemistry results with baseline, change, visits, end of treatment, limits and flags."""
    group = ["USUBJID", "PARAMCD"]
    record = [*group, "LBSEQ"]
    out = merges.join_supp(lb.filter(F.col("LBCAT") == "CHEMISTRY"), supplb, SUBJECT, supp_names, "LBSEQ")
    carried = [
        "SUBJID", "TRT01PN", "TRT01P", "TRT01AN", "TRT01A", "TRTSDT", "TRTEDT", "AGE", "AGEGR1", "AGEGR1N", "RACE", "RACEN", "SEX",
        "COMP24FL", "DSRAEFL", "SAFFL",
    ]
    out = merges.merge_vars(out, adsl, SUBJECT, [c for c in carried if c in adsl.columns and c not in out.columns])
    out = out.withColumns({
        "ADT": impute_date("LBDTC", "n"),
        "AVAL": F.col("LBSTRESN"),
        "AVALC": longitudinal.text_result("LBSTRESN", "LBSTRESC"),
        "PARAM": paste("LBTEST", F.lit(" ("), "LBSTRESU", F.lit(")")),
        "PARAMCD": F.col("LBTESTCD"),
        "PARCAT1": F.lit("CHEM"),
        "ABLFL": F.col("LBBLFL"),
    })
    out = out.withColumn("ADY", study_day("ADT", "TRTSDT"))
    if param_codes:
        out = merges.map_codelist(out, param_codes, "PARAM", "PARAMN")
    # The indicator rests on the record's own value and limits, so both baselines come
    # from the same flagged records before any record is copied; the indicator's baseline
    # counts only records that stay in the table.
    out = out.withColumn("ANRIND", longitudinal.range_indicator())
    planned = F.col("VISIT").contains("WEEK") | F.col("VISIT").contains("UNSCHEDULED") | F.col("VISIT").contains("SCREENING")
    stays = planned | (F.col("ENDPOINT") == "Y") | (F.col("VISITNUM") == 12)
    marked = out.filter(F.col("ABLFL") == "Y").groupBy(*PARAMETER).agg(
        F.when(F.count("*") == 1, F.max("AVAL")).otherwise(F.raise_error(F.lit("more than one baseline record"))).alias("BASE"),
        F.max(F.when(stays, F.col("ANRIND"))).alias("BNRIND"),
    )
    out = lookup_join(out, marked, PARAMETER)
    out = out.withColumn("CHG", if_else(F.col("VISITNUM") == 1, F.lit(None).cast("double"), longitudinal.change()))

    named = longitudinal.name_visits(out)
    visits, fallback = longitudinal.end_of_treatment(
        named, PARAMETER, ["LBSEQ"], endpoint=F.col("ENDPOINT") == "Y", last_visit=F.col("VISITNUM") == 12,
        after=F.col("VISITNUM") == 13, kept=planned,
    )
    on_treatment = (
        (F.col("VISITNUM") <= 12) & (F.col("AVISITN") > 0) & (F.col("AVISITN") != 99) & ~F.col("VISIT").contains("UN")
    )
    visits = longitudinal.flag_latest_visit(visits, group, record, on_treatment, "_latest")
    visits = visits.withColumn("AENTMTFL", merges.flag_or_keep("AENTMTFL", "_latest")).drop("_latest")
    out = longitudinal.limit_ratios(visits.unionByName(fallback)).withColumn(
        "ALBTRVAL", longitudinal.threshold_distance("LBSTRESN", "LBSTNRLO", "LBSTNRHI")
    )
    scheduled = F.col("VISITNUM").between(4, 12) & ~F.col("VISIT").contains("UN")
    out = longitudinal.flag_furthest(out, group, "ALBTRVAL", record, "ANL01FL", scheduled)
    out = out.withColumns({"TRTP": F.col("TRT01P"), "TRTPN": F.col("TRT01PN"), "TRTA": F.col("TRT01A"), "TRTAN": F.col("TRT01AN")})
    return _finish(out, spec)


# ------------------------------------------------------------------- time to event
def time_to_first_event(ds: DataFrame, adsl: DataFrame, adae: DataFrame, spec: TableSpec | None = None) -> DataFrame:
    """Days from first dose to the first dermatologic event, else to the end of the study."""
    ended = ds.filter(
        (F.col("DSCAT") == "DISPOSITION EVENT") & ~F.col("DSDECOD").isin("SCREEN FAILURE", "FINAL LAB VISIT")
    ).select(*SUBJECT, parse_iso_date("DSSTDTC").alias("EOSDT"))
    subjects = merges.merge_vars(adsl.drop("EOSDT"), ended, SUBJECT, ["EOSDT"], one_to_one=True)
    end = survival.censor_date("DCDECOD", parse_iso_date("RFENDTC"), F.col("EOSDT"))
    subjects = subjects.withColumn("EOS2DT", end)
    first = (F.col("AOCC01FL") == "Y") & (F.col("CQ01NAM") == values.CUSTOM_QUERY_NAME) & (F.col("SAFFL") == "Y")
    event = survival.EventSource("adae", "ASTDT", first, {
        "EVNTDESC": values.EVENT_TEXT, "SRCDOM": "ADAE", "SRCVAR": "ASTDT", "SRCSEQ": F.col("AESEQ").cast("double"),
    })
    censor = survival.CensorSource("adsl", "EOS2DT", None, {
        "EVNTDESC": values.CENSOR_TEXT, "SRCDOM": "ADSL", "SRCVAR": "RFENDT", "SRCSEQ": F.lit(None).cast("double"),
    })
    out = survival.time_to_event(
        subjects, "TRTSDT", [event], [censor], {"adae": adae, "adsl": subjects}, SUBJECT,
        {"PARAMCD": "TTDE", "PARAM": "Time to First Dermatologic Event"},
    ).withColumn("AVAL", duration("STARTDT", "ADT"))
    carried = {
        "TRTA": "TRT01A", "TRTAN": "TRT01AN", "TRTDUR": "TRTDURD", "TRTP": "TRT01P",
        **{c: c for c in ("AGE", "AGEGR1", "AGEGR1N", "RACE", "RACEN", "SAFFL", "SEX", "SITEID", "TRTEDT", "TRTSDT")},
    }
    carried = {new: old for new, old in carried.items() if old in adsl.columns}
    return _finish(merges.merge_vars(out, adsl, SUBJECT, carried, one_to_one=True), spec)


# ------------------------------------------------------------------- questionnaire scores
def score_parameters() -> list[str]:
    """The item codes ACITM01 to ACITM14 and the total."""
    return [f"ACITM{i:02d}" for i in range(1, 15)] + ["ACTOT"]


def scores(
    qs: DataFrame, adsl: DataFrame, param_codes: Mapping[str, int] | None = None, window_rows: Sequence[tuple] = values.SCORE_WINDOWS,
    spec: TableSpec | None = None,
) -> DataFrame:
    """Scores with visit windows, closest-record flag, carried totals, baseline and change."""
    from_subject = {
        "TRTP": "TRT01P", "TRTPN": "TRT01PN",
        **{c: c for c in ("SITEID", "SITEGR1", "TRTSDT", "TRTEDT", "AGE", "AGEGR1", "AGEGR1N", "RACE", "RACEN", "SEX", "ITTFL", "EFFFL", "COMP24FL")},
    }
    from_subject = {new: old for new, old in from_subject.items() if old in adsl.columns}
    windows = ranges.windows(window_rows)
    rows = qs.filter(F.col("QSTESTCD").isin(score_parameters())).select(
        *SUBJECT, "QSSEQ", "VISIT", "VISITNUM", F.col("QSTESTCD").alias("PARAMCD"), title_case("QSTEST").alias("PARAM"),
        F.col("QSSTRESN").alias("AVAL"), parse_iso_date("QSDTC").alias("ADT"), F.col("QSBLFL").alias("ABLFL"),
    )
    out = merges.merge_vars(rows, adsl, SUBJECT, from_subject)
    out = out.withColumn("ADY", study_day("ADT", "TRTSDT"))
    keep = ["VISIT", "VISITNUM", "ADY", "ADT", "PARAM", "QSSEQ"]
    if param_codes:
        out = merges.map_codelist(out, param_codes, "PARAM", "PARAMN")
        keep.append("PARAMN")
    out = ranges.visit_of_day(out, windows)
    record = [*SUBJECT, "QSSEQ"]
    # Only the total has expected visits; a total missing at one is carried forward from
    # the chosen records.
    closest = {"by": ["USUBJID", "PARAMCD", "AVISIT"], "row_key": record, "where": F.col("AVISIT").isNotNull()}
    chosen = longitudinal.closest_records(out.filter(F.col("PARAMCD") == "ACTOT"), **closest)
    expected = [(w.number, w.label) for w in windows]
    constant = list(from_subject)
    out = longitudinal.locf(
        longitudinal.flag_closest(out, **closest), PARAMETER, expected, keep, ["QSSEQ"], constant=constant, pool=chosen
    )
    out = out.withColumn("ANL01FL", F.when(F.col("DTYPE").isNull(), F.col("ANL01FL")).otherwise(F.lit("Y")))
    out = ranges.window_deviation(ranges.window_of_visit(out, windows))
    out = longitudinal.baseline(out, PARAMETER, "AVAL", "BASE", check=True)
    off = F.col("ABLFL").isNull()
    out = out.withColumns({"CHG": F.when(off, longitudinal.change()), "PCHG": F.when(off, longitudinal.percent_change())})
    return _finish(out, spec)


