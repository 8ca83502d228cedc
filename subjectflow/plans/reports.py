"""Report tables assembled from summary and model operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subjectflow.functions import values
from subjectflow.functions.cells import mean_or_null
from subjectflow.functions.formats import fixed, fmt_ci, fmt_est, fmt_pval, masked, num_fmt
from subjectflow.operators import summary
from subjectflow.operators.merges import population_right_join
from subjectflow.operators.models import ancova_factor, ancova_two_arm, ancova_two_arm_report, pairwise_report
from subjectflow.operators.summary import population_n
from subjectflow.operators.survival import km_curve, risk_table

# Row labels of the model part of the primary table.
DOSE_LABEL = "p-value(Dose Response) [1][2]"
ACTIVE_LABEL = "p-value(Xan - Placebo) [1][3]"
BETWEEN_LABEL = "p-value(Xan High - Xan Low) [1][3]"
DIFF_LABEL = "  Diff of LS Means (SE)"
CI_LABEL = "  95% CI"


def efficacy_rows(
    fit: DataFrame, contrasts: Mapping[str, tuple[str, int]], dose_arm: str, arms: Sequence[str], prefix: str = "var1_"
) -> DataFrame:
    """Model results as label rows with one text column per arm, in ``ord`` order.

    ``contrasts`` maps a contrast to its arm column and its first row (1 against placebo,
    5 between active arms). Row 0 is the dose test, -1 and 4 are blank spacers.
    """
    difference = F.concat(num_fmt("estimate", 1, 4, 2), F.lit(" ("), num_fmt("se", 2, 4, 1), F.lit(")"))
    limits = F.concat(F.lit("("), num_fmt("lower", 1, 4, 2), F.lit(";"), num_fmt("upper", 1, 3, 1), F.lit(")"))
    p_text = num_fmt("p_value", 3, 12, 4)
    column, first = F.when(F.col("test") == "dose", dose_arm), F.when(F.col("test") == "dose", -1)
    for name, (arm, row) in contrasts.items():
        column, first = column.when(F.col("test") == name, arm), first.when(F.col("test") == name, row)

    def entry(offset: int, text):
        return F.struct((first + offset).alias("ord"), F.col(text).alias("text"))

    entries = F.when(
        F.col("test") == "dose", F.array(entry(0, "_p"), entry(1, "_blank"))
    ).when(first == 1, F.array(entry(0, "_p"), entry(1, "_d"), entry(2, "_c"), entry(3, "_blank"))
    ).otherwise(F.array(entry(0, "_p"), entry(1, "_d"), entry(2, "_c")))
    fit = fit.withColumns({"_p": p_text, "_d": difference, "_c": limits, "_blank": F.lit("")})
    tall = fit.filter(first.isNotNull()).select(column.alias("arm"), F.explode(entries).alias("_e")).select("arm", "_e.*")
    wide = tall.groupBy("ord").agg(*[
        F.coalesce(F.max(F.when(F.col("arm") == a, F.col("text"))), F.lit("")).alias(f"{prefix}{a}") for a in arms
    ])
    labels = {-1: DOSE_LABEL, 1: ACTIVE_LABEL, 2: DIFF_LABEL, 3: CI_LABEL, 5: BETWEEN_LABEL, 6: DIFF_LABEL, 7: CI_LABEL}
    label = F
    for position, text in labels.items():
        label = label.when(F.col("ord") == position, F.lit(text))
    return wide.select("ord", label.otherwise(F.lit("")).alias("row_label"), *[f"{prefix}{a}" for a in arms])


# ------------------------------------------------------------------- report tables
# Variables and labels of the demographic table, in report order.
DEMOGRAPHICS = [
    ("AGE", "Age"), ("AGEGR1", "Pooled Age Group 1"), ("RACE", "Race"), ("HEIGHTBL", "Baseline Height (cm)"),
    ("WEIGHTBL", "Baseline Weight (kg)"), ("BMIBL", "Baseline BMI (kg/m^2)"), ("MMSETOT", "MMSE Total"),
]
_ARMS = list(values.ARM_CODES)


def demographics(adsl: DataFrame, arms: Sequence[str] = tuple(_ARMS), study: str | None = None) -> DataFrame:
    """Demographic table of the intent-to-treat subjects: one text column per arm.

    Rows carry ``block`` and ``ord`` for sorting; the (N=...) row is block 0.
    """
    itt = adsl.filter((F.col("ITTFL") == "Y") & F.col("TRT01P").isin(list(arms)))
    if study is not None:
        itt = itt.filter(F.col("STUDYID") == study)
    levels = {"AGEGR1": values.AGE_GROUPS, "RACE": values.RACE_LEVELS}
    block = {name: i for i, (name, _) in enumerate(DEMOGRAPHICS, start=1)}
    numeric = [name for name, _ in DEMOGRAPHICS if name not in levels]

    stats = summary.describe(itt, ["TRT01P"], numeric).select(
        "TRT01P", "variable", masked("xx.xx (xx.xx)", "mean", "sd", align=False).alias("_1"),
        masked("xx.xx", "median", align=False).alias("_2"), masked("xx.xx - xx.xx", "min", "max", align=False).alias("_3"),
    )
    labels = ["Mean (sd)", "Median", "Min - Max"]
    rows = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(label).alias("row_label"), F.col(f"_{i}").alias("text"))
        for i, label in enumerate(labels, start=1)
    ])
    described = stats.select("TRT01P", "variable", F.explode(rows).alias("_e")).select("TRT01P", "variable", "_e.*")
    counted = summary.category_counts(itt, "TRT01P", arms, levels).select(
        "TRT01P", "variable", F.col("level_no").alias("ord"), F.col("level").alias("row_label"), F.col("n").cast("string").alias("text")
    )
    totals = itt.groupBy("TRT01P").agg(F.count("*").alias("_n")).select(
        "TRT01P", F.lit("").alias("variable"), F.lit(0).alias("ord"), F.lit("").alias("row_label"),
        F.format_string("(N=%d)", "_n").alias("text"),
    )
    tall = described.unionByName(counted).unionByName(totals)
    number, title = F, F
    for name, label in DEMOGRAPHICS:
        number = number.when(F.col("variable") == name, F.lit(block[name]))
        title = title.when(F.col("variable") == name, F.lit(label))
    cells = [F.max(F.when(F.col("TRT01P") == a, F.col("text"))).alias(a) for a in arms]
    return tall.groupBy(number.otherwise(F.lit(0)).alias("block"), title.otherwise(F.lit("")).alias("variable_label"), "ord", "row_label").agg(*cells)


def chemistry_efficacy(
    adsl: DataFrame, adlbc: DataFrame, param: str = "GLUC", visit: int = 20, active: str = "Xanomeline High Dose", control: str = "Placebo"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Week-20 covariance table of one analyte: arm rows, pairwise row, error row."""
    itt = adsl.filter(F.col("ITTFL") == "Y").select("STUDYID", "USUBJID")
    arms = [active, control]
    rows = population_right_join(adlbc, itt, ["STUDYID", "USUBJID"]).filter(
        F.col("TRTP").isin(arms) & (F.col("PARAMCD") == param) & F.col("AVISITN").isNotNull()
    )
    at_base = rows.filter(F.col("AVISITN") == 0).groupBy("TRTP").agg(
        F.count("*").alias("N1"), mean_or_null("BASE").alias("_mb"), F.stddev_samp("BASE").alias("_sb")
    )
    later = rows.filter((F.col("AVISITN") == visit) & F.col("CHG").isNotNull() & F.col("BASE").isNotNull())
    at_visit = later.groupBy("TRTP").agg(
        F.count("*").alias("N2"), F.avg("CHG").alias("_mc"), F.stddev_samp("CHG").alias("_sc"),
        mean_or_null("AVAL").alias("_ma"), F.stddev_samp("AVAL").alias("_sa"),
    )
    fit = ancova_two_arm(rows.filter(F.col("AVISITN") == visit), "CHG", "BASE", "TRTP", arms)
    means = ancova_two_arm_report(fit, arms).withColumnRenamed("arm", "TRTP")
    table = at_base.join(at_visit, "TRTP").join(means, "TRTP").select(
        F.col("TRTP").alias("Trt"), "N1", fmt_est("_mb", "_sb").alias("Mean1"), "N2", fmt_est("_ma", "_sa").alias("Mean2"),
        F.col("N2").alias("N3"), fmt_est("_mc", "_sc").alias("Mean3"), fmt_ci("lsmean", "lower", "upper").alias("CI"),
    )
    pair = pairwise_report(fit)
    comparison = pair.select(
        F.lit(f"{active} vs. {control}").alias("comp"), fmt_ci("estimate", "lower", "upper").alias("mean"), fmt_pval("p_value").alias("p")
    )
    error = pair.select(F.concat(F.lit("Root Mean Squared Error of Change = "), fixed("rmse", 2)).alias("rmse"))
    return table, comparison, error


def primary_endpoint(adsl: DataFrame, adadas: DataFrame, arms: Sequence[str] = tuple(_ARMS), visit: int = 24) -> tuple[DataFrame, DataFrame]:
    """Primary table body (summary rows, then model rows) and its column header.

    Sort the body by section, ord_layer_index, ord_layer_1, ord_layer_2.
    """
    placebo, low, high = arms
    rows = adadas.filter(
        (F.col("EFFFL") == "Y") & (F.col("ITTFL") == "Y") & (F.col("PARAMCD") == "ACTOT") & (F.col("ANL01FL") == "Y")
    )
    population = population_n(adsl.filter((F.col("EFFFL") == "Y") & (F.col("ITTFL") == "Y")).withColumnRenamed("TRT01P", "TRTP"), "TRTP", "USUBJID")
    header = summary.arm_header(rows, "TRTP", "TRTPN", population, names=arms).select(
        F.replace("header", F.lit("|Xanomeline "), F.lit("|Xanomeline\\line ")).alias("header")
    )
    layers = [
        ("Baseline", "AVAL", F.col("AVISITN") == 0),
        (f"Week {visit}", "AVAL", F.col("AVISITN") == visit),
        ("Change from Baseline", "CHG", F.col("AVISITN") == visit),
    ]
    body = summary.stat_rows(summary.layered_summary(rows, "TRTP", arms, layers), "TRTP", arms, [
        ("n", masked("xx", "n")),
        ("Mean (SD)", masked("xx.x (xx.xx)", "mean", "sd")),
        ("Median (Range)", masked("xx.x (xxx;xx)", "median", "min", "max")),
    ])
    body = body.withColumnsRenamed({"layer_no": "ord_layer_index", "layer": "row_label1"}).withColumn("ord_layer_1", F.lit(1))
    nested = summary.nest_row_labels(body).withColumn("section", F.lit(1))
    factor_arms = [high, low, placebo]
    fit = ancova_factor(
        rows.filter(F.col("AVISITN") == visit), "CHG", "TRTP", factor_arms, [values.ARM_CODES[a] for a in factor_arms],
        ["Xan_Hi", "Xan_Lo", "Pbo"], "SITEGR1", "BASE",
    )
    names = {"Xan_Lo - Pbo": (low, 1), "Xan_Hi - Pbo": (high, 1), "Xan_Hi - Xan_Lo": (high, 5)}
    model = efficacy_rows(fit, names, high, [low, high]).withColumnRenamed("ord", "ord_layer_index").withColumn("section", F.lit(2))
    body = nested.unionByName(model, allowMissingColumns=True)
    return body.fillna("", subset=[c for c in body.columns if c.startswith("var1_")]), header


def survival_by_arm(adsl: DataFrame, adtte: DataFrame, study: str | None = None, times: Sequence[int] = tuple(range(0, 201, 20))) -> tuple[DataFrame, DataFrame]:
    """Kaplan-Meier curve and risk table of the safety subjects."""
    safe = adsl.filter(F.col("SAFFL") == "Y").select("STUDYID", "USUBJID", "TRT01A")
    timed = adtte.filter(F.col("PARAMCD") == "TTDE").select("STUDYID", "USUBJID", "AVAL", "CNSR")
    if study is not None:
        safe, timed = safe.filter(F.col("STUDYID") == study), timed.filter(F.col("STUDYID") == study)
    rows = safe.join(timed, ["STUDYID", "USUBJID"], "inner")
    return km_curve(rows, "TRT01A"), risk_table(rows, "TRT01A", times)
