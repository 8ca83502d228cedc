"""Queries on the subject and exposure tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from subjectflow.functions.cells import if_else, n_distinct, round_half_up, safe_ratio, sum_or_null
from subjectflow.operators import merges, picks, ranges, summary
from subjectflow.operators.joins import lookup_join
from subjectflow.plans.analogs import ARM_NUMBERS, ARMS, exposure, raw_results, reference_dates, steady, subjects, table, windowed, with_views
from subjectflow.plans.registry import query

AGE_RANGES = ["<65", "65-80", ">80"]
IN_ARM = "arm in ('Placebo', 'Low Dose', 'High Dose')"

_HALF_UP = "sign({0}) * floor(abs({0}) * {1} + (0.5 + 1.0 / 67108864)) / {1}"


def half_up_sql(expression: str, digits: int) -> str:
    """Half-up rounding in SQL, step for step as the Spark function."""
    return _HALF_UP.format(f"({expression})", f"CAST({10**digits} AS DOUBLE)")


@query(
    "describe_by_arm",
    with_views("subject", """, v AS (
        SELECT arm, 'age' AS variable, CAST(age AS DOUBLE) AS value FROM subject
        UNION ALL SELECT arm, 'measure', measure FROM subject)
      SELECT arm, variable, COUNT(value) AS n, round(AVG(value) + 3e-10, 6) AS mean, round(STDDEV_SAMP(value) + 3e-10, 6) AS sd,
        round(MEDIAN(value) + 3e-10, 6) AS median, MIN(value) AS min, MAX(value) AS max
      FROM v WHERE arm IN ('Placebo', 'Low Dose', 'High Dose') GROUP BY arm, variable"""),
)
def describe_by_arm(spark, sf_dir):
    """n, mean, sd, median, minimum, maximum of two variables by arm."""
    stats = summary.describe(subjects(spark, sf_dir).filter(IN_ARM), ["arm"], ["age", "measure"])
    return stats.select("arm", "variable", "n", *[steady(c).alias(c) for c in ("mean", "sd", "median")], "min", "max")


@query(
    "category_counts",
    with_views("subject", """, s AS (
        SELECT s.*, r_name AS region, CASE WHEN age < 65 THEN '<65' WHEN age BETWEEN 65 AND 80 THEN '65-80'
          WHEN age > 80 THEN '>80' END AS agegr1
        FROM subject s LEFT JOIN nation ON siteid = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
      grid AS (SELECT * FROM (VALUES ('Placebo'), ('Low Dose'), ('High Dose')) a(arm),
        (VALUES ('agegr1', 1, '<65'), ('agegr1', 2, '65-80'), ('agegr1', 3, '>80'), ('region', 1, 'AFRICA'),
          ('region', 2, 'AMERICA'), ('region', 3, 'ASIA'), ('region', 4, 'EUROPE'), ('region', 5, 'MIDDLE EAST'),
          ('region', 6, 'ATLANTIS')) l(variable, level_no, level)),
      c AS (SELECT arm, 'agegr1' AS variable, agegr1 AS level, COUNT(*) AS n FROM s GROUP BY 1, 3
        UNION ALL SELECT arm, 'region', region, COUNT(*) FROM s GROUP BY 1, 3)
      SELECT g.arm, g.variable, g.level_no, g.level, COALESCE(c.n, 0) AS n
      FROM grid g LEFT JOIN c ON g.arm = c.arm AND g.variable = c.variable AND g.level = c.level"""),
)
def category_counts(spark, sf_dir):
    """Counts by arm for fixed levels, zero cells included."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("siteid"), "n_regionkey")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    s = subjects(spark, sf_dir).join(nation, "siteid", "left").join(region, "n_regionkey", "left")
    s = ranges.range_category(s, "age", AGE_RANGES, "agegr1")
    return summary.category_counts(s, "arm", ARMS, {"agegr1": AGE_RANGES, "region": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "ATLANTIS"]})


@query(
    "population_n",
    with_views("subject trtref", """
      SELECT a.arm, COUNT(DISTINCT s.usubjid) AS n
      FROM (VALUES ('Placebo'), ('Low Dose'), ('High Dose')) a(arm)
      LEFT JOIN (SELECT s.usubjid, s.arm FROM subject s JOIN trtref USING (usubjid)) s ON a.arm = s.arm GROUP BY 1"""),
)
def population_n(spark, sf_dir):
    """Distinct treated subjects by arm."""
    treated = subjects(spark, sf_dir).join(reference_dates(spark, sf_dir), "usubjid", "left")
    return summary.population_n(treated, "arm", "usubjid", F.col("trtsdt").isNotNull(), arms=ARMS)


@query(
    "arm_header",
    with_views("subject trtref", """, c AS (
        SELECT arm, armn, COUNT(DISTINCT usubjid) AS n FROM subject
        WHERE arm IN ('Placebo', 'Low Dose', 'High Dose') GROUP BY 1, 2)
      SELECT string_agg('|' || arm || '\\line(N=' || n || ')', '' ORDER BY armn) AS header FROM c"""),
)
def arm_header(spark, sf_dir):
    """Column header text with the arms in order and their population counts."""
    s = subjects(spark, sf_dir).filter(IN_ARM)
    return summary.arm_header(s, "arm", "armn", summary.population_n(s, "arm", "usubjid"), names=ARMS)


@query(
    "age_groups",
    with_views("subject", """
      SELECT usubjid, age, CASE WHEN age < 65 THEN '<65' WHEN age BETWEEN 65 AND 80 THEN '65-80' WHEN age > 80 THEN '>80' END AS agegr1,
        CASE WHEN age < 65 THEN 1 WHEN age BETWEEN 65 AND 80 THEN 2 WHEN age > 80 THEN 3 END AS agegr1n FROM subject"""),
)
def age_groups(spark, sf_dir):
    """Range category and its code."""
    s = subjects(spark, sf_dir).select("usubjid", "age")
    return ranges.range_category(s, "age", AGE_RANGES, "agegr1", "agegr1n")


@query(
    "pooled_sites",
    with_views("subject", """, cells AS (
        SELECT siteid, MIN(n) AS smallest FROM (
          SELECT siteid, SUM(CASE WHEN arm = a THEN 1 ELSE 0 END) AS n
          FROM subject, (VALUES ('Placebo'), ('Low Dose'), ('High Dose')) l(a) GROUP BY siteid, a) GROUP BY siteid)
      SELECT s.usubjid, CASE WHEN smallest < 10 THEN '900' ELSE CAST(s.siteid AS VARCHAR) END AS sitegr1
      FROM subject s JOIN cells USING (siteid) WHERE arm IN ('Placebo', 'Low Dose', 'High Dose')"""),
)
def pooled_sites(spark, sf_dir):
    """Sites with too few subjects in any arm go to group 900."""
    from subjectflow.operators.subject import pool_small_sites

    s = subjects(spark, sf_dir).filter(IN_ARM)
    return pool_small_sites(s, "siteid", "arm", ARMS, "sitegr1", smallest=10).select("usubjid", "sitegr1")


# ------------------------------------------------------------------- exposure
@query(
    "cumulative_dose",
    with_views("exposure", """
      SELECT usubjid, trt, COUNT(DISTINCT trt) AS cnt,
        CASE WHEN COUNT(*) = COUNT(exendt) THEN round(SUM(dose * (exendt - exstdt + 1)), 2) END AS cumdose
      FROM exposure GROUP BY usubjid, trt"""),
)
def cumulative_dose(spark, sf_dir):
    """Cumulative dose per subject and treatment; null as soon as one dose is unknown."""
    ex = exposure(spark, sf_dir).withColumn("amount", F.col("dose") * (F.datediff("exendt", "exstdt") + 1))
    return ex.groupBy("usubjid", "trt").agg(
        n_distinct("trt").alias("cnt"), F.round(sum_or_null("amount"), 2).alias("cumdose")
    )


@query(
    "mixed_treatment",
    with_views("exposure", """
      SELECT usubjid, COUNT(DISTINCT trt) AS n_trt FROM exposure GROUP BY usubjid HAVING COUNT(DISTINCT trt) > 1"""),
)
def mixed_treatment(spark, sf_dir):
    """Subjects exposed to more than one treatment."""
    return exposure(spark, sf_dir).groupBy("usubjid").agg(F.count_distinct("trt").alias("n_trt")).filter("n_trt > 1")


_EXPOSURE_SQL = """, lastdisp AS (
        SELECT usubjid, arg_max(status, (exstdt, seq)) AS status, MAX(exstdt) AS eosdt FROM exposure GROUP BY usubjid),
      closed AS (SELECT e.*, COALESCE(exendt, CASE WHEN l.status <> 'F' THEN l.eosdt END) AS endt
        FROM exposure e JOIN lastdisp l USING (usubjid)),
      summed AS (SELECT usubjid, MIN(CASE WHEN dose > 1000 THEN exstdt END) AS trtsdt,
          MAX(CASE WHEN dose > 1000 THEN endt END) AS trtedt,
          CASE WHEN COUNT(*) = COUNT(endt) THEN round(SUM(dose * (endt - exstdt + 1)), 2) END AS cumdose
        FROM closed GROUP BY usubjid)"""


@query(
    "exposure_summary",
    with_views("exposure", _EXPOSURE_SQL + f"""
      SELECT usubjid, trtsdt, trtedt, CAST(trtedt - trtsdt + 1 AS INTEGER) AS trtdurd, cumdose,
        {half_up_sql("cumdose / nullif(CAST(trtedt - trtsdt + 1 AS DOUBLE), 0)", 1)} AS avgdd
      FROM summed"""),
)
def exposure_summary(spark, sf_dir):
    """First and last dose date, duration, cumulative and average dose per subject.

    A missing end date is the subject's last date if the subject discontinued.
    """
    from subjectflow.operators.subject import dose_summary

    ex = exposure(spark, sf_dir)
    last = picks.pick_row(ex, ["usubjid"], ["exstdt", "seq"], "last").select(
        "usubjid", F.col("exstdt").alias("eosdt"), F.col("status").alias("laststatus")
    )
    ex = lookup_join(ex, last, ["usubjid"]).withColumn(
        "exendt", F.coalesce("exendt", F.when(F.col("laststatus") != "F", F.col("eosdt")))
    )
    out = dose_summary(ex, ["usubjid"], "exstdt", "exendt", "dose", F.col("dose") > 1000)
    return out.select(
        "usubjid", "trtsdt", "trtedt", "trtdurd", F.round("cumdose", 2).alias("cumdose"),
        round_half_up(safe_ratio(F.round("cumdose", 2), "trtdurd"), 1).alias("avgdd"),
    )


@query(
    "disposition",
    with_views("exposure", """, lastdisp AS (
        SELECT usubjid, arg_max(status, (exstdt, seq)) AS status, MAX(exstdt) AS eosdt, arg_max(trt, (exstdt, seq)) AS trt
        FROM exposure GROUP BY usubjid), d AS (
        SELECT usubjid, eosdt, trt, CASE status WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'ADVERSE EVENT' ELSE 'OTHER' END AS dcdecod
        FROM lastdisp)
      SELECT usubjid, eosdt, dcdecod, CASE WHEN dcdecod = 'COMPLETED' THEN 'COMPLETED' ELSE 'DISCONTINUED' END AS eosstt,
        CASE WHEN dcdecod <> 'COMPLETED' THEN 'Y' END AS disconfl,
        CASE WHEN dcdecod = 'ADVERSE EVENT' THEN 'Y' END AS dsraefl,
        CASE WHEN dcdecod = 'COMPLETED' THEN '' WHEN trt = '1-URGENT' THEN 'I/E Not Met'
          WHEN dcdecod = 'ADVERSE EVENT' THEN 'Adverse Event' ELSE 'Other' END AS dcsreas
      FROM d"""),
)
def disposition(spark, sf_dir):
    """End-of-study status, discontinuation flags and reason with an override."""
    from subjectflow.operators.subject import disposition_vars

    last = picks.pick_row(exposure(spark, sf_dir), ["usubjid"], ["exstdt", "seq"], "last")
    decod = F.when(F.col("status") == "F", "COMPLETED").when(F.col("status") == "O", "ADVERSE EVENT").otherwise("OTHER")
    d = last.select("usubjid", F.col("exstdt").alias("eosdt"), decod.alias("dcdecod"), F.col("trt"))
    return disposition_vars(
        d, "dcdecod", "eosdt", term="dcdecod", reasons={"ADVERSE EVENT": "Adverse Event", "OTHER": "Other"},
        override=F.col("trt") == "1-URGENT", override_text="I/E Not Met",
    ).select("usubjid", "eosdt", "dcdecod", "eosstt", "disconfl", "dsraefl", "dcsreas")


_EFF = """, eff AS (SELECT user_id AS usubjid, COUNT(DISTINCT event_type) AS effcnt FROM events
        WHERE event_type IN ('purchase', 'view') AND value > 20 GROUP BY 1)"""


@query("eff_population", with_views("trtref", _EFF + " SELECT usubjid, effcnt FROM eff"))
def eff_population(spark, sf_dir):
    """Number of distinct efficacy tests per subject among the qualifying records."""
    rows = raw_results(spark, sf_dir).filter(F.col("paramcd").isin("purchase", "view") & (F.col("aval") > 20))
    return rows.groupBy("usubjid").agg(n_distinct("paramcd").alias("effcnt"))


@query(
    "population_flags",
    with_views("subject trtref", _EFF + """
      SELECT s.usubjid, s.armcd,
        CASE WHEN armcd <> 'Scrnfail' AND armcd <> '' AND trtsdt IS NOT NULL THEN 'Y' WHEN armcd = 'Scrnfail' THEN NULL ELSE 'N' END AS saffl,
        CASE WHEN armcd <> 'Scrnfail' AND armcd <> '' THEN 'Y' WHEN armcd = 'Scrnfail' THEN NULL ELSE 'N' END AS ittfl,
        CASE WHEN armcd <> 'Scrnfail' AND armcd <> '' AND trtsdt IS NOT NULL AND effcnt = 2 THEN 'Y'
          WHEN armcd = 'Scrnfail' THEN NULL ELSE 'N' END AS efffl
      FROM subject s LEFT JOIN trtref USING (usubjid) LEFT JOIN eff USING (usubjid)"""),
)
def population_flags(spark, sf_dir):
    """Safety, intent-to-treat and efficacy flags."""
    from subjectflow.operators.subject import population_flag_vars

    s = subjects(spark, sf_dir).select("usubjid", "armcd")
    s = s.join(reference_dates(spark, sf_dir), "usubjid", "left").join(eff_population(spark, sf_dir), "usubjid", "left")
    return population_flag_vars(s, "armcd", "trtsdt", "effcnt").select("usubjid", "armcd", "saffl", "ittfl", "efffl")


@query(
    "visit_compliance",
    with_views("windowed", """
      SELECT usubjid, MAX(CASE WHEN avisit = 'Week 1' THEN 'Y' ELSE 'N' END) AS comp1fl,
        MAX(CASE WHEN avisit = 'Week 2' THEN 'Y' ELSE 'N' END) AS comp2fl,
        MAX(CASE WHEN avisit = 'Week 3' THEN 'Y' ELSE 'N' END) AS comp3fl
      FROM windowed WHERE paramcd = 'purchase' GROUP BY usubjid"""),
)
def visit_compliance(spark, sf_dir):
    """Visit-completion flags: every subject with a visit has at least N."""
    from subjectflow.operators.subject import visit_flags

    v = windowed(spark, sf_dir).filter("paramcd = 'purchase'")
    return visit_flags(v, ["usubjid"], "AVISIT", {"comp1fl": "Week 1", "comp2fl": "Week 2", "comp3fl": "Week 3"})


@query(
    "subject_level",
    with_views("subject exposure trtref", _EXPOSURE_SQL + _EFF + """
      SELECT s.usubjid, s.siteid, s.arm AS trt01p, s.armn AS trt01pn, s.arm AS trt01a, s.armn AS trt01an, s.age,
        CASE WHEN age < 65 THEN '<65' WHEN age BETWEEN 65 AND 80 THEN '65-80' WHEN age > 80 THEN '>80' END AS agegr1,
        x.trtsdt AS exsdt, x.trtedt AS exedt, x.cumdose, r.trtsdt, e.effcnt,
        CASE WHEN armcd <> '' AND r.trtsdt IS NOT NULL THEN 'Y' ELSE 'N' END AS saffl,
        CASE WHEN l.status = 'F' THEN 'COMPLETED' WHEN l.status IS NOT NULL THEN 'DISCONTINUED' END AS eosstt
      FROM subject s LEFT JOIN summed x USING (usubjid) LEFT JOIN trtref r USING (usubjid) LEFT JOIN eff e USING (usubjid)
        LEFT JOIN lastdisp l USING (usubjid)
      WHERE s.armcd <> 'Scrnfail'"""),
)
def subject_level(spark, sf_dir):
    """One row per subject: treatment, exposure, disposition, efficacy counts and flags.

    Every side table is reduced to one row per subject on the subject key before the
    joins, so each input is shuffled once and all joins share that partitioning.
    """
    from subjectflow.operators.subject import dose_summary, population_flag_vars, treatment_vars

    ex = exposure(spark, sf_dir)
    last = picks.pick_row(ex, ["usubjid"], ["exstdt", "seq"], "last").select(
        "usubjid", F.col("exstdt").alias("eosdt"), F.col("status").alias("laststatus")
    )
    closed = lookup_join(ex, last, ["usubjid"]).withColumn(
        "exendt", F.coalesce("exendt", F.when(F.col("laststatus") != "F", F.col("eosdt")))
    )
    valid = F.col("dose") > 1000
    dosed = dose_summary(closed, ["usubjid"], "exstdt", "exendt", "dose", valid, carry=["laststatus"]).select(
        "usubjid", F.col("trtsdt").alias("exsdt"), F.col("trtedt").alias("exedt"), F.round("cumdose", 2).alias("cumdose"), "laststatus"
    )
    s = subjects(spark, sf_dir).filter("armcd <> 'Scrnfail'")
    s = ranges.range_category(s, "age", AGE_RANGES, "agegr1")
    for part in (dosed, reference_dates(spark, sf_dir), eff_population(spark, sf_dir)):
        s = s.join(part, "usubjid", "left")
    s = treatment_vars(population_flag_vars(s, "armcd", "trtsdt", "effcnt"), "arm", ARM_NUMBERS, "trt01p", "trt01a")
    status = if_else(F.col("laststatus") == "F", F.lit("COMPLETED"), F.lit("DISCONTINUED"))
    return s.select(
        "usubjid", "siteid", "trt01p", F.col("trt01pN").alias("trt01pn"), "trt01a", F.col("trt01aN").alias("trt01an"), "age", "agegr1", "exsdt", "exedt", "cumdose", "trtsdt", "effcnt", "saffl",
        status.alias("eosstt"),
    )


@query(
    "merge_first_last",
    with_views("subject exposure", """
      SELECT s.usubjid, f.exstdt AS firstdt, f.trt AS firsttrt, l.exendt AS lastdt, l.seq AS lastseq
      FROM subject s
      LEFT JOIN (SELECT usubjid, exstdt, trt FROM exposure WHERE dose > 50000
        QUALIFY ROW_NUMBER() OVER (PARTITION BY usubjid ORDER BY exstdt NULLS LAST, seq) = 1) f USING (usubjid)
      LEFT JOIN (SELECT usubjid, exendt, seq FROM exposure WHERE dose > 50000
        QUALIFY ROW_NUMBER() OVER (PARTITION BY usubjid ORDER BY exendt DESC NULLS FIRST, seq DESC) = 1) l USING (usubjid)"""),
)
def merge_first_last(spark, sf_dir):
    """First exposure by start date and last by end date (nulls sort last), merged to subjects."""
    s, ex = subjects(spark, sf_dir).select("usubjid"), exposure(spark, sf_dir)
    dosed = F.col("dose") > 50000
    s = merges.merge_vars(s, ex, ["usubjid"], {"firstdt": "exstdt", "firsttrt": "trt"}, dosed, ["exstdt", "seq"], one_to_one=True)
    return merges.merge_vars(s, ex, ["usubjid"], {"lastdt": "exendt", "lastseq": "seq"}, dosed, ["exendt", "seq"], "last", one_to_one=True)


@query(
    "unique_keys",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def unique_keys(spark, sf_dir):
    """Keys that break uniqueness."""
    return merges.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "population_right_join",
    with_views("subject results", """
      SELECT s.usubjid, COUNT(r.seq) AS n_rows, round(SUM(r.aval) + 3e-10, 6) AS total
      FROM results r RIGHT JOIN (SELECT usubjid FROM subject WHERE arm IN ('Placebo', 'Low Dose', 'High Dose')) s USING (usubjid)
      GROUP BY s.usubjid"""),
)
def population_right_join(spark, sf_dir):
    """Results restricted to the population; subjects without results stay."""
    itt = subjects(spark, sf_dir).filter(IN_ARM).select("usubjid")
    joined = merges.population_right_join(raw_results(spark, sf_dir).select("usubjid", "seq", "aval"), itt, ["usubjid"])
    return joined.groupBy("usubjid").agg(F.count("seq").alias("n_rows"), steady(F.sum("aval")).alias("total"))


@query(
    "codelist_map",
    """SELECT s_suppkey, s_nationkey, n_name AS nation, CASE n_regionkey WHEN 0 THEN 'AFRICA' WHEN 1 THEN 'AMERICA'
         WHEN 2 THEN 'ASIA' END AS region3
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def codelist_map(spark, sf_dir):
    """Code to decode through a codelist table and through a literal codelist."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation")
    coded = n.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("decode"))
    out = merges.map_codelist(s, coded, "s_nationkey", "nation", decode_to_code=False)
    regions = n.select(F.col("n_nationkey").alias("code"), F.col("n_regionkey").alias("decode"))
    out = merges.map_codelist(out, regions, "s_nationkey", "rk", decode_to_code=False)
    out = merges.map_codelist(out, {0: "AFRICA", 1: "AMERICA", 2: "ASIA"}, "rk", "region3")
    return out.select("s_suppkey", "s_nationkey", "nation", "region3")


@query(
    "predecessors",
    with_views("subject exposure", """, firstex AS (SELECT usubjid, MIN(exstdt) AS trtsdt FROM exposure GROUP BY usubjid)
      SELECT e.seq AS exseq, e.usubjid, s.age, s.arm AS trtp, f.trtsdt, e.dose AS aval
      FROM exposure e LEFT JOIN subject s USING (usubjid) LEFT JOIN firstex f USING (usubjid)"""),
)
def predecessors(spark, sf_dir):
    """Columns mapping one-to-one from several tables, assembled from a mapping."""
    ex = exposure(spark, sf_dir)
    first = ex.groupBy("usubjid").agg(F.min("exstdt").alias("trtsdt"))
    return merges.build_predecessors(
        {"EX": ex, "SUBJECT": subjects(spark, sf_dir), "FIRST": first},
        {"exseq": ("EX", "seq"), "usubjid": ("EX", "usubjid"), "age": ("SUBJECT", "age"), "trtp": ("SUBJECT", "arm"),
         "trtsdt": ("FIRST", "trtsdt"), "aval": ("EX", "dose")},
        "EX", ["usubjid"],
    )


