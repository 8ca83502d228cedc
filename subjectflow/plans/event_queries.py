"""Queries on long results and occurrences."""

from __future__ import annotations

from pyspark.sql import functions as F

from subjectflow.functions import cells, dates
from subjectflow.functions.cells import round_half_up, safe_ratio
from subjectflow.operators import longitudinal, merges, occurrence, picks, ranges
from subjectflow.plans.analogs import (
    EXPECTED_VISITS, PARAMS, baselined, occurrences, raw_results, reference_dates, results, steady, table, windowed, with_views,
)
from subjectflow.plans.registry import query
from subjectflow.plans.subject_queries import half_up_sql

PAIR = ["usubjid", "paramcd"]


# ------------------------------------------------------------------- dates
@query(
    "impute_dates",
    with_views("occurrence", """
      SELECT aeseq, CASE length(startdtc) WHEN 19 THEN CAST(substr(startdtc, 1, 10) AS DATE) END AS dt_none,
        CASE length(startdtc) WHEN 19 THEN CAST(substr(startdtc, 1, 10) AS DATE) WHEN 7 THEN CAST(startdtc || '-01' AS DATE) END AS dt_day,
        CASE length(startdtc) WHEN 19 THEN CAST(substr(startdtc, 1, 10) AS DATE) WHEN 7 THEN last_day(CAST(startdtc || '-01' AS DATE))
          ELSE CAST(startdtc || '-12-31' AS DATE) END AS dt_month,
        CASE length(startdtc) WHEN 19 THEN CAST(substr(startdtc, 1, 10) AS DATE) ELSE adt END AS dt_capped,
        CASE length(startdtc) WHEN 7 THEN 'D' WHEN 4 THEN 'M' END AS imputed
      FROM occurrence"""),
)
def impute_dates(spark, sf_dir):
    """Partial ISO text to dates at four imputation levels."""
    o = occurrences(spark, sf_dir)
    out = o.select(
        "aeseq", "startdtc",
        dates.impute_date("startdtc", "n").alias("dt_none"),
        dates.impute_date("startdtc", "D").alias("dt_day"),
        dates.impute_date("startdtc", "M", "last").alias("dt_month"),
        dates.impute_date("startdtc", "Y", "last", max_dates=["adt"]).alias("dt_capped"),
    )
    return out.withColumn("imputed", dates.date_imputed_flag("startdtc", F.col("dt_month"))).drop("startdtc")


@query(
    "impute_datetimes",
    with_views("occurrence", """
      SELECT aeseq, CASE length(startdtc) WHEN 19 THEN CAST(replace(startdtc, 'T', ' ') AS TIMESTAMP)
          WHEN 7 THEN CAST(startdtc || '-01 00:00:00' AS TIMESTAMP) END AS astdtm,
        CASE length(startdtc) WHEN 19 THEN CAST(replace(startdtc, 'T', ' ') AS TIMESTAMP) END AS aendtm,
        CASE length(startdtc) WHEN 19 THEN CAST(substr(startdtc, 1, 10) AS DATE) WHEN 7 THEN CAST(startdtc || '-01' AS DATE) END AS astdt
      FROM occurrence"""),
)
def impute_datetimes(spark, sf_dir):
    """Partial ISO text to datetimes (day level, time level) and back to a date."""
    o = occurrences(spark, sf_dir).select(
        "aeseq",
        dates.impute_datetime("startdtc", "D").alias("astdtm"),
        dates.impute_datetime("startdtc", "h").alias("aendtm"),
    )
    return o.withColumn("astdt", F.col("astdtm").cast("date"))


@query("study_day", with_views("results", " SELECT usubjid, seq, ady FROM results"))
def study_day(spark, sf_dir):
    """Study day against the reference date, without a day 0."""
    return results(spark, sf_dir).select("usubjid", "seq", "ady")


_ASTDT = """, dated AS (SELECT o.*, trtsdt,
          CASE length(startdtc) WHEN 19 THEN CAST(substr(startdtc, 1, 10) AS DATE) WHEN 7 THEN CAST(startdtc || '-01' AS DATE) END AS astdt,
          CASE WHEN serious = 'N' THEN adt + CAST(aeseq % 9 AS INTEGER) END AS aendt
        FROM occurrence o LEFT JOIN trtref USING (usubjid))"""


def dated_occurrences(spark, sf_dir):
    """Occurrences with imputed start, an end date and the reference date."""
    o = occurrences(spark, sf_dir)
    o = merges.merge_vars(o, reference_dates(spark, sf_dir), ["usubjid"], ["trtsdt"], unique=True)
    return o.withColumns({
        "astdt": dates.impute_date("startdtc", "D"),
        "aendt": F.when(F.col("serious") == "N", F.date_add("adt", (F.col("aeseq") % 9).cast("int"))),
    })


@query(
    "durations",
    with_views("occurrence trtref", _ASTDT + f"""
      SELECT aeseq, CAST(aendt - astdt + 1 AS INTEGER) AS adurn, CASE WHEN aendt - astdt IS NOT NULL THEN 'DAYS' END AS aduru,
        {half_up_sql("CAST(aendt - astdt + 1 AS DOUBLE) / 30.4375", 1)} AS adurm
      FROM dated"""),
)
def durations(spark, sf_dir):
    """Duration in days with its unit, and in months to one decimal."""
    o = dated_occurrences(spark, sf_dir).withColumn("adurn", dates.duration("astdt", "aendt"))
    return o.select(
        "aeseq", "adurn", dates.duration_unit("adurn", "DAYS").alias("aduru"),
        round_half_up(dates.duration("astdt", "aendt", "months"), 1).alias("adurm"),
    )


# ------------------------------------------------------------------- occurrences
@query(
    "treatment_emergent",
    with_views("occurrence trtref", _ASTDT + " SELECT aeseq, astdt, CASE WHEN astdt >= trtsdt THEN 'Y' END AS trtemfl FROM dated"),
)
def treatment_emergent(spark, sf_dir):
    """Treatment-emergent flag, derived only on records with a start date."""
    flag = {"trtemfl": occurrence.treatment_emergent("astdt", "aendt", "trtsdt")}
    o = picks.restrict_columns(dated_occurrences(spark, sf_dir), flag, F.col("astdt").isNotNull())
    return o.select("aeseq", "astdt", "trtemfl")


_CQ = ("term", "class", ["click_0", "view_0"], "error", ["error_1", "error_2"], "QUERY 1")
_CQ_SQL = "(term LIKE '%click_0%' OR term LIKE '%view_0%' OR class LIKE '%error%' AND NOT (term LIKE '%error_1%' OR term LIKE '%error_2%'))"


@query(
    "custom_query",
    with_views("occurrence", f" SELECT aeseq, term, CASE WHEN {_CQ_SQL} THEN 'QUERY 1' END AS cq01nam FROM occurrence"),
)
def custom_query(spark, sf_dir):
    """Custom query name from term and class texts."""
    return occurrences(spark, sf_dir).select("aeseq", "term", occurrence.custom_query(*_CQ).alias("cq01nam"))


_EM = "(astdt >= trtsdt)"


def _first(names: str, condition: str) -> str:
    return (
        f"CASE WHEN {condition} AND ROW_NUMBER() OVER (PARTITION BY {names}, coalesce({condition}, false) "
        "ORDER BY astdt NULLS LAST, aeseq) = 1 THEN 'Y' END"
    )


@query(
    "first_occurrence_flags",
    with_views("occurrence trtref", _ASTDT + f"""
      SELECT usubjid, aeseq, {_first("usubjid", _EM)} AS aoccfl, {_first("usubjid, class", _EM)} AS aoccsfl,
        {_first("usubjid, class, term", _EM)} AS aoccpfl,
        {_first("usubjid", _EM + " AND serious = 'Y'")} AS aocc02fl,
        {_first("usubjid, class", _EM + " AND serious = 'Y'")} AS aocc03fl,
        {_first("usubjid, class, term", _EM + " AND serious = 'Y'")} AS aocc04fl,
        {_first("usubjid", _EM + " AND " + _CQ_SQL)} AS aocc01fl
      FROM dated"""),
)
def first_occurrence_flags(spark, sf_dir):
    """Seven first-occurrence flags from one nested reduction."""
    o = dated_occurrences(spark, sf_dir).withColumn("trtemfl", occurrence.treatment_emergent("astdt", None, "trtsdt"))
    o = o.withColumn("cq01nam", occurrence.custom_query(*_CQ))
    names = ("aoccfl", "aoccsfl", "aoccpfl", "aocc02fl", "aocc03fl", "aocc04fl", "aocc01fl")
    flagged = occurrence.occurrence_flags(
        o, "usubjid", "class", "term", "astdt", "aeseq", F.col("trtemfl") == "Y", F.col("serious") == "Y",
        F.col("cq01nam") == "QUERY 1", names,
    )
    return flagged.select("usubjid", "aeseq", *names)


# ------------------------------------------------------------------- visits and windows
@query(
    "visit_window",
    with_views("windowed", """
      SELECT seq, ady, avisit AS "AVISIT", avisitn AS "AVISITN", awtarget AS "AWTARGET",
        CASE avisitn WHEN 0 THEN '<=1' WHEN 1 THEN '2-8' WHEN 2 THEN '9-15' WHEN 3 THEN '>15' END AS "AWRANGE",
        CASE avisitn WHEN 1 THEN 2 WHEN 2 THEN 9 WHEN 3 THEN 16 END AS "AWLO",
        CASE avisitn WHEN 0 THEN 1 WHEN 1 THEN 8 WHEN 2 THEN 15 END AS "AWHI" FROM windowed"""),
)
def visit_window(spark, sf_dir):
    """Analysis visit and window attributes by study day."""
    return windowed(spark, sf_dir).select("seq", "ady", "AVISIT", "AVISITN", "AWRANGE", "AWTARGET", "AWLO", "AWHI")


@query(
    "locf_visit_table",
    with_views("results", """, r AS (SELECT usubjid, paramcd, ady, aval, seq FROM results WHERE ady IS NOT NULL),
      v AS (SELECT DISTINCT paramcd, ady AS n FROM r WHERE ady % 3 = 0),
      obs AS (SELECT usubjid, paramcd, ady, arg_max(aval, seq) AS aval, max(seq) AS seq FROM r WHERE aval IS NOT NULL GROUP BY 1, 2, 3),
      pair AS (SELECT DISTINCT usubjid, paramcd FROM obs),
      gaps AS (SELECT p.usubjid, p.paramcd, v.n FROM pair p JOIN v ON v.paramcd = p.paramcd
        ANTI JOIN obs o ON o.usubjid = p.usubjid AND o.paramcd = p.paramcd AND o.ady = v.n)
      SELECT usubjid, paramcd, ady, aval, seq, CAST(NULL AS VARCHAR) AS dtype FROM r
      UNION ALL SELECT g.usubjid, g.paramcd, g.n, o.aval, o.seq, 'LOCF' FROM gaps g ASOF JOIN obs o ON g.usubjid = o.usubjid AND g.paramcd = o.paramcd AND g.n > o.ady"""),
)
def locf_visit_table(spark, sf_dir):
    """Values carried to every third study day that any subject has for the parameter: expected visits as rows."""
    r = results(spark, sf_dir).filter("ady IS NOT NULL").select("usubjid", "paramcd", "ady", "aval", "seq")
    visits = r.filter("ady % 3 = 0").select("paramcd", "ady").distinct()
    out = longitudinal.locf_table(r, PAIR, visits, ["seq"], ["seq"], "ady", None, "aval", visit_by=["paramcd"])
    return out.select("usubjid", "paramcd", "ady", "aval", "seq", F.col("DTYPE").alias("dtype"))


@query(
    "interval_lookup",
    """WITH i AS (SELECT p_name, p_brand, CAST(p_partkey AS DOUBLE) / 8 AS low, (CAST(p_partkey AS DOUBLE) + 0.75::DOUBLE) / 8 AS high FROM part)
       SELECT event_id, value, p_name, p_brand, low FROM events LEFT JOIN i ON value >= low AND value < high""",
)
def interval_lookup(spark, sf_dir):
    """The interval, out of as many as there are parts, that holds a measured value."""
    key = F.col("p_partkey").cast("double")
    bands = table(spark, sf_dir, "part").select("p_name", "p_brand", (key / 8).alias("low"), ((key + F.lit(0.75)) / 8).alias("high"))
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return ranges.interval_lookup(events, "value", bands, "low", "high", ["p_name", "p_brand", "low"], ends="[)")


@query(
    "interval_overlaps",
    """WITH i AS (SELECT s_suppkey, CAST(s_suppkey AS DOUBLE) AS low, CASE WHEN s_suppkey % 10 > 0 THEN s_suppkey + CAST(s_nationkey AS DOUBLE) / 10 END AS high FROM supplier)
       SELECT event_id, s_suppkey FROM events LEFT JOIN i ON value >= low AND (high IS NULL OR value <= high) WHERE event_id % 2 = 0""",
)
def interval_overlaps(spark, sf_dir):
    """Every interval that holds a value, where intervals overlap or are open."""
    first = F.col("s_suppkey").cast("double")
    bands = table(spark, sf_dir, "supplier").select(
        "s_suppkey", first.alias("low"), F.when(F.col("s_suppkey") % 10 > 0, first + F.col("s_nationkey").cast("double") / 10).alias("high")
    )
    events = table(spark, sf_dir, "events").filter("event_id % 2 = 0").select("event_id", "value")
    return ranges.interval_lookup(events, "value", bands, "low", "high", ["s_suppkey"], overlaps="list").select("event_id", "s_suppkey")


@query(
    "visit_window_table",
    with_views("results", """, w AS (SELECT ['click', 'error', 'purchase', 'signup', 'view'][n_nationkey % 5 + 1] AS paramcd, n_name, n_nationkey,
          CASE WHEN n_nationkey >= 5 THEN (n_nationkey // 5) * 6 + n_nationkey % 5 END AS wlo, CASE WHEN n_nationkey < 20 THEN (n_nationkey // 5) * 6 + n_nationkey % 5 + 5 END AS whi FROM nation)
      SELECT seq, ady, n_name AS "AVISIT", n_nationkey AS "AVISITN", wlo AS "AWLO", whi AS "AWHI"
      FROM results r LEFT JOIN w ON w.paramcd = r.paramcd AND (wlo IS NULL OR ady >= wlo) AND (whi IS NULL OR ady <= whi) AND ady IS NOT NULL"""),
)
def visit_window_table(spark, sf_dir):
    """Analysis visits from a table of windows that differ by parameter, the outer ones open."""
    n, number = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    start = F.floor(number / 5).cast("int") * 6 + number % 5
    windows = n.select(
        F.element_at(F.array(*[F.lit(p) for p in PARAMS]), (number % 5 + 1).cast("int")).alias("paramcd"), F.col("n_name").alias("AVISIT"), number.alias("AVISITN"),
        F.lit(None).cast("string").alias("AWRANGE"), F.lit(None).cast("int").alias("AWTARGET"),
        F.when(number >= 5, start).cast("int").alias("AWLO"), F.when(number < 20, start + 5).cast("int").alias("AWHI"),
    )
    found = ranges.visit_of_day_table(results(spark, sf_dir), windows, "ady", ["paramcd"])
    return found.select("seq", "ady", "AVISIT", "AVISITN", "AWLO", "AWHI")


_CLOSEST = """, closest AS (SELECT *, abs(awtarget - ady) AS awtdiff, CASE WHEN avisit IS NOT NULL AND ROW_NUMBER() OVER (
          PARTITION BY usubjid, paramcd, avisit ORDER BY abs(awtarget - ady), awtarget - ady, seq) = 1 THEN 'Y' END AS anl01fl
        FROM windowed)"""


def closest(spark, sf_dir):
    w = ranges.window_deviation(windowed(spark, sf_dir), "ady")
    return longitudinal.flag_closest(
        w, [*PAIR, "AVISIT"], ["seq"], "anl01fl", "ady", "AWTARGET", F.col("AVISIT").isNotNull()
    )


@query(
    "closest_visit",
    with_views("windowed", _CLOSEST + " SELECT seq, avisitn, CAST(awtdiff AS INTEGER) AS awtdiff, anl01fl FROM closest"),
)
def closest_visit(spark, sf_dir):
    """Record closest to the window target per subject, parameter and visit."""
    return closest(spark, sf_dir).select("seq", F.col("AVISITN").alias("avisitn"), F.col("AWTDIFF").alias("awtdiff"), "anl01fl")


@query(
    "baseline_change",
    with_views("based", """
      SELECT seq, aval, ablfl, base, CASE WHEN ablfl IS NULL THEN round(aval - base + 3e-10, 6) END AS chg,
        CASE WHEN ablfl IS NULL AND base <> 0 THEN round(100 * (aval - base) / abs(base) + 3e-10, 6) END AS pchg FROM based"""),
)
def baseline_change(spark, sf_dir):
    """Baseline value on every row, change and percent change off baseline."""
    b = baselined(spark, sf_dir)
    off = F.col("ablfl").isNull()
    return b.select(
        "seq", "aval", "ablfl", "base",
        F.when(off, steady(longitudinal.change("aval", "base"))).alias("chg"),
        F.when(off, steady(longitudinal.percent_change("aval", "base"))).alias("pchg"),
    )


@query(
    "locf",
    with_views("windowed", _CLOSEST + """,
      obs AS (SELECT usubjid, paramcd, avisitn, avisit, aval, adt, ady, seq FROM closest WHERE anl01fl = 'Y' AND aval IS NOT NULL),
      expected AS (SELECT DISTINCT usubjid, paramcd, n AS avisitn, v AS avisit FROM obs,
        (VALUES (0, 'Baseline'), (1, 'Week 1'), (2, 'Week 2'), (3, 'Week 3')) x(n, v)),
      gaps AS (SELECT e.* FROM expected e ANTI JOIN obs o ON e.usubjid = o.usubjid AND e.paramcd = o.paramcd AND e.avisitn = o.avisitn),
      added AS (SELECT g.usubjid, g.paramcd, g.avisitn, g.avisit, o.aval, o.adt, o.ady, o.seq,
          ROW_NUMBER() OVER (PARTITION BY g.usubjid, g.paramcd, g.avisitn ORDER BY o.avisitn DESC) AS rn
        FROM gaps g JOIN obs o ON g.usubjid = o.usubjid AND g.paramcd = o.paramcd AND o.avisitn < g.avisitn)
      SELECT usubjid, paramcd, avisitn, avisit, aval, adt, ady, seq, anl01fl, CAST(NULL AS VARCHAR) AS dtype FROM closest
      UNION ALL SELECT usubjid, paramcd, avisitn, avisit, aval, adt, ady, seq, 'Y', 'LOCF' FROM added WHERE rn = 1"""),
)
def locf(spark, sf_dir):
    """Missing expected visits filled with the last earlier flagged value."""
    c = closest(spark, sf_dir)
    # The flagged records come straight from the choice, not from the flagged table.
    chosen = longitudinal.closest_records(
        windowed(spark, sf_dir), [*PAIR, "AVISIT"], ["seq"], "ady", "AWTARGET", F.col("AVISIT").isNotNull()
    )
    out = longitudinal.locf(
        c, PAIR, EXPECTED_VISITS, keep=["adt", "ady", "seq"], row_key=["seq"], value="aval", pool=chosen
    )
    return out.select(
        "usubjid", "paramcd", F.col("AVISITN").alias("avisitn"), F.col("AVISIT").alias("avisit"), "aval", "adt", "ady", "seq",
        F.when(F.col("DTYPE").isNull(), F.col("anl01fl")).otherwise(F.lit("Y")).alias("anl01fl"), F.col("DTYPE").alias("dtype"),
    )


_VISIT_SQL = """, visits AS (SELECT *, CASE WHEN aval > 200 THEN 'UNSCHEDULED 3.1' WHEN avisitn = 0 THEN 'SCREENING 1'
          ELSE upper(avisit) END AS visit FROM baselined),
      named AS (SELECT *, CASE WHEN ablfl = 'Y' THEN 'Baseline' WHEN visit LIKE '%UNSCHEDULED%' THEN ''
          ELSE upper(substr(visit, 1, 1)) || lower(substr(visit, 2)) END AS vname FROM visits),
      numbered AS (SELECT *, CASE WHEN vname = 'Baseline' THEN 0 ELSE TRY_CAST(regexp_replace(vname, '[^0-9]', '', 'g') AS DOUBLE) END AS vnum
        FROM named)"""


def visits(spark, sf_dir):
    b = baselined(spark, sf_dir)
    visit = F.when(F.col("aval") > 200, "UNSCHEDULED 3.1").when(F.col("AVISITN") == 0, "SCREENING 1").otherwise(F.upper("AVISIT"))
    return b.withColumns({"VISIT": visit, "VISITNUM": F.col("AVISITN")})


@query("visit_number", with_views("baselined", _VISIT_SQL + " SELECT seq, visit, vname AS avisit, vnum AS avisitn FROM numbered"))
def visit_number(spark, sf_dir):
    """Visit names in sentence case and the number in them; baseline is 0."""
    v = longitudinal.name_visits(visits(spark, sf_dir), "VISIT", "ablfl")
    return v.select("seq", F.col("VISIT").alias("visit"), F.col("AVISIT").alias("avisit"), F.col("AVISITN").alias("avisitn"))


@query(
    "end_of_treatment",
    with_views("baselined", _VISIT_SQL + """,
      both_ AS (SELECT usubjid, paramcd, seq, aval, vname AS avisit, vnum AS avisitn, '' AS aentmtfl FROM numbered
        UNION ALL SELECT usubjid, paramcd, seq, aval, 'End of Treatment', 99, 'Y' FROM numbered WHERE aval > 150 OR avisitn = 3 AND aval > 60),
      top AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY usubjid, paramcd ORDER BY avisitn DESC NULLS LAST, seq) AS rn
        FROM both_ WHERE aval <= 300)
      SELECT usubjid, paramcd, seq, avisit, CAST(avisitn AS DOUBLE) AS avisitn, aentmtfl FROM both_
      UNION ALL SELECT usubjid, paramcd, seq, 'End of Treatment', 99, 'Y' FROM top
        WHERE rn = 1 AND avisitn IS NOT NULL AND avisitn NOT IN (0, 99)"""),
)
def end_of_treatment(spark, sf_dir):
    """Visit-99 copies of endpoint records, with the last real visit as fallback."""
    v = longitudinal.name_visits(visits(spark, sf_dir).withColumn("windown", F.col("AVISITN")), "VISIT", "ablfl")
    both, fallback = longitudinal.end_of_treatment(
        v, PAIR, ["seq"], endpoint=F.col("aval") > 150, last_visit=(F.col("windown") == 3) & (F.col("aval") > 60),
        after=F.col("aval") > 300,
    )
    return both.unionByName(fallback).select(
        "usubjid", "paramcd", "seq", F.col("AVISIT").alias("avisit"), F.col("AVISITN").alias("avisitn"),
        F.col("AENTMTFL").alias("aentmtfl"),
    )


@query(
    "group_max_flag",
    with_views("windowed", """
      SELECT seq, avisitn, MAX(avisitn) OVER w AS maxn, CASE WHEN MAX(avisitn) OVER w = avisitn THEN 'Y' ELSE '' END AS maxfl
      FROM windowed WINDOW w AS (PARTITION BY usubjid, paramcd)"""),
)
def group_max_flag(spark, sf_dir):
    """Highest visit of the group on each row, and a flag on the rows at it."""
    w = windowed(spark, sf_dir).withColumnRenamed("AVISITN", "avisitn")
    return picks.flag_group_max(w, PAIR, "avisitn", "maxfl", "maxn").select("seq", "avisitn", "maxn", "maxfl")


@query(
    "full_join_flag",
    with_views("windowed", """, pool AS (SELECT usubjid, paramcd, seq, avisitn, MAX(avisitn) OVER (PARTITION BY usubjid, paramcd) AS m
        FROM windowed WHERE aval < 100)
      SELECT seq, avisitn, CASE WHEN seq IN (SELECT seq FROM pool) THEN
          CASE WHEN seq IN (SELECT seq FROM pool WHERE avisitn = m) THEN 'Y' ELSE '' END END AS lastfl
      FROM windowed"""),
)
def full_join_flag(spark, sf_dir):
    """A flag derived on part of the rows, stamped onto all rows by a full join."""
    w = windowed(spark, sf_dir).withColumnRenamed("AVISITN", "avisitn")
    pool = w.filter("aval < 100").select(*PAIR, "seq", "avisitn")
    marks = picks.flag_group_max(pool, PAIR, "avisitn", "lastfl").select(*PAIR, "seq", "lastfl")
    return merges.stamp_full_join(w, marks, [*PAIR, "seq"]).select("seq", "avisitn", "lastfl")


_LIMITS = """, lim AS (SELECT * REPLACE (CASE paramcd WHEN 'view' THEN NULL WHEN 'click' THEN 0.0 ELSE lo END AS lo,
          CASE paramcd WHEN 'purchase' THEN NULL ELSE hi END AS hi) FROM based)"""


def limited(spark, sf_dir):
    return _with_limits(baselined(spark, sf_dir))


def _with_limits(rows):
    return rows.withColumns({
        "lo": F.when(F.col("paramcd") == "click", 0.0).when(F.col("paramcd") != "view", F.col("lo")),
        "hi": F.when(F.col("paramcd") != "purchase", F.col("hi")),
    })


@query(
    "analysis_flag",
    with_views("based", _LIMITS + """, far AS (SELECT *, abs(aval - 1.5 * hi) AS one, abs(0.5 * lo - aval) AS two FROM lim),
      dist AS (SELECT *, CASE WHEN one > two THEN one WHEN one <= two THEN two END AS albtrval FROM far),
      best AS (SELECT seq, albtrval, ROW_NUMBER() OVER (PARTITION BY usubjid, paramcd ORDER BY albtrval DESC NULLS LAST, seq) AS rn
        FROM dist WHERE avisitn BETWEEN 1 AND 3)
      SELECT d.seq, round(d.albtrval + 3e-10, 6) AS albtrval, CASE WHEN b.rn = 1 AND b.albtrval IS NOT NULL THEN 'Y' END AS anl01fl
      FROM dist d LEFT JOIN best b ON d.seq = b.seq AND b.rn = 1"""),
)
def analysis_flag(spark, sf_dir):
    """Flag the post-baseline record furthest outside its limits per subject and parameter."""
    d = limited(spark, sf_dir).withColumn("albtrval", longitudinal.threshold_distance("aval", "lo", "hi"))
    flagged = longitudinal.flag_furthest(d, PAIR, "albtrval", ["seq"], "anl01fl", F.col("AVISITN").between(1, 3))
    return flagged.select("seq", steady("albtrval").alias("albtrval"), "anl01fl")


@query(
    "range_indicator",
    with_views("based", _LIMITS + """, ind AS (SELECT *, CASE WHEN aval IS NULL THEN 'N' WHEN aval < 0.5 * lo THEN 'L'
          WHEN 0.5 * lo IS NULL THEN NULL WHEN aval > 1.5 * hi THEN 'H' WHEN hi IS NULL THEN NULL ELSE 'N' END AS anrind FROM lim)
      SELECT seq, anrind, MAX(CASE WHEN ablfl = 'Y' THEN anrind END) OVER (PARTITION BY usubjid, paramcd) AS bnrind FROM ind"""),
)
def range_indicator(spark, sf_dir):
    """Range indicator and its baseline value; a missing limit gives null."""
    ind = _with_limits(windowed(spark, sf_dir)).withColumn("anrind", longitudinal.range_indicator("aval", "lo", "hi"))
    found = longitudinal.baseline_record(ind, PAIR, ["adt"], ["seq"], {"bnrind": "anrind"}, "ablfl", where=F.col("AVISITN") == 0)
    return found.select("seq", "anrind", "bnrind")


@query(
    "limit_ratios",
    with_views("based", _LIMITS + """
      SELECT seq, lo AS a1lo, hi AS a1hi, round(aval / nullif(lo, 0) + 3e-10, 6) AS r2a1lo, round(aval / nullif(hi, 0) + 3e-10, 6) AS r2a1hi,
        round(base / nullif(lo, 0) + 3e-10, 6) AS br2a1lo, round(base / nullif(hi, 0) + 3e-10, 6) AS br2a1hi FROM lim"""),
)
def limit_ratios(spark, sf_dir):
    """Ratios of value and baseline to the range limits; null for a zero limit."""
    d = limited(spark, sf_dir).withColumns({"AVAL": F.col("aval"), "BASE": F.col("base")})
    r = longitudinal.limit_ratios(d, "lo", "hi")
    return r.select("seq", F.col("A1LO").alias("a1lo"), F.col("A1HI").alias("a1hi"),
                    *[steady(c).alias(c.lower()) for c in ("R2A1LO", "R2A1HI", "BR2A1LO", "BR2A1HI")])


@query(
    "param_label",
    with_views("results", """
      SELECT seq, paramcd || ' (' || CASE paramcd WHEN 'view' THEN 'NA' ELSE 'unit' END || ')' AS param,
        CASE paramcd WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'signup' THEN 3 END AS paramn,
        'ITEM' || CASE WHEN length(CAST(usubjid AS VARCHAR)) >= 3 THEN CAST(usubjid AS VARCHAR) ELSE lpad(CAST(usubjid AS VARCHAR), 3, '0') END AS itemcd,
        'EVENT' AS parcat1 FROM results"""),
)
def param_label(spark, sf_dir):
    """Parameter label (missing unit prints NA), code by codelist, padded item code."""
    r = results(spark, sf_dir).withColumn("unit", F.when(F.col("paramcd") != "view", "unit"))
    r = r.withColumn("param", cells.paste("paramcd", F.lit(" ("), "unit", F.lit(")")))
    r = merges.map_codelist(r, {"click (unit)": 1, "error (unit)": 2, "signup (unit)": 3}, "param", "paramn")
    item = F.concat(F.lit("ITEM"), cells.pad_left("usubjid", 3, "0"))
    return r.select("seq", "param", "paramn", item.alias("itemcd"), F.lit("EVENT").alias("parcat1"))


@query(
    "supp_qualifiers",
    """WITH supp AS (SELECT user_id AS usubjid, lpad(CAST(event_id AS VARCHAR), 12, ' ') AS idvarval,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
       wide AS (SELECT usubjid, TRY_CAST(trim(idvarval) AS BIGINT) AS seq, CAST(k AS VARCHAR) AS k,
         CASE WHEN k % 2 = 1 THEN 'Y' END AS odd FROM supp WHERE k < 80)
       SELECT e.user_id AS usubjid, e.event_id AS seq, w.k AS "K", w.odd AS "ODD"
       FROM events e LEFT JOIN wide w ON e.user_id = w.usubjid AND e.event_id = w.seq""",
)
def supp_qualifiers(spark, sf_dir):
    """Name/value qualifiers pivoted and joined back to their parent records."""
    r = raw_results(spark, sf_dir)
    k = F.get_json_object("props", "$.k")
    pairs = F.array(
        F.struct(F.lit("K").alias("QNAM"), k.alias("QVAL")),
        F.when(k.cast("int") % 2 == 1, F.struct(F.lit("ODD").alias("QNAM"), F.lit("Y").alias("QVAL"))),
    )
    supp = r.filter(k.cast("int") < 80).select(
        "usubjid", cells.pad_left("seq", 12).alias("IDVARVAL"), F.explode(pairs).alias("_q")
    ).filter(F.col("_q").isNotNull()).select("usubjid", "IDVARVAL", "_q.*")
    return merges.join_supp(r.select("usubjid", "seq"), supp, ["usubjid"], ["K", "ODD"], "seq")


# ------------------------------------------------------------------- per subject
@query(
    "last_visit",
    with_views("windowed", """
      SELECT usubjid, CASE WHEN avisitn = 3 THEN 2 ELSE avisitn END AS visnumen FROM windowed WHERE aval < 300
      QUALIFY ROW_NUMBER() OVER (PARTITION BY usubjid ORDER BY adt DESC, seq DESC) = 1"""),
)
def last_visit(spark, sf_dir):
    """Last scheduled visit number per subject, with the follow-up visit counted as the one before."""
    w = windowed(spark, sf_dir).filter("aval < 300")
    last = picks.pick_row(w.select("usubjid", "adt", "seq", "AVISITN"), ["usubjid"], ["adt", "seq"], "last")
    return last.select("usubjid", cells.if_else(F.col("AVISITN") == 3, F.lit(2), F.col("AVISITN")).alias("visnumen"))


@query(
    "baseline_wide",
    with_views("baselined", f""", wide AS (SELECT usubjid,
          MAX(CASE WHEN paramcd = 'click' THEN {half_up_sql("aval + 120", 1)} END) AS heightbl,
          MAX(CASE WHEN paramcd = 'view' THEN {half_up_sql("aval + 40", 1)} END) AS weightbl
        FROM baselined WHERE ablfl = 'Y' GROUP BY usubjid),
      bmi AS (SELECT *, {half_up_sql("weightbl / ((heightbl / 100.0) * (heightbl / 100.0))", 1)} AS bmibl FROM wide)
      SELECT *, CASE WHEN bmibl < 25 THEN '<25' WHEN bmibl BETWEEN 25 AND 30 THEN '25-30' WHEN bmibl > 30 THEN '>30' END AS bmiblgr1 FROM bmi"""),
)
def baseline_wide(spark, sf_dir):
    """Baseline values side by side, body mass index and its group."""
    b = baselined(spark, sf_dir).filter("ablfl = 'Y'")
    wide = b.groupBy("usubjid").agg(
        F.max(F.when(F.col("paramcd") == "click", round_half_up(F.col("aval") + 120, 1))).alias("heightbl"),
        F.max(F.when(F.col("paramcd") == "view", round_half_up(F.col("aval") + 40, 1))).alias("weightbl"),
    )
    meters = F.col("heightbl") / 100.0
    wide = wide.withColumn("bmibl", round_half_up(safe_ratio("weightbl", meters * meters), 1))
    return ranges.range_category(wide, "bmibl", ["<25", "25-30", ">30"], "bmiblgr1")


@query(
    "score_total",
    """WITH s AS (SELECT user_id AS usubjid, event_type, CASE WHEN k % 10 = 0 THEN 'NA' WHEN k % 10 = 1 THEN '' ELSE '  ' || k END AS orres
         FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events))
       SELECT usubjid, event_type, COALESCE(SUM(TRY_CAST(trim(orres) AS DOUBLE)), 0) AS total FROM s GROUP BY 1, 2""",
)
def score_total(spark, sf_dir):
    """Total of text scores; text that is no number is left out, none at all gives 0."""
    r = raw_results(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("int")
    text = F.when(k % 10 == 0, "NA").when(k % 10 == 1, "").otherwise(F.concat(F.lit("  "), k.cast("string")))
    scored = r.select("usubjid", F.col("paramcd").alias("event_type"), text.alias("orres"))
    return scored.groupBy("usubjid", "event_type").agg(cells.sum_or_zero(cells.to_number("orres")).alias("total"))
