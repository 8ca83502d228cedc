"""Time-to-event, report tables and models on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from subjectflow.functions import formats
from subjectflow.operators import linear, longitudinal, merges, models, summary, survival
from subjectflow.plans.analogs import ARM_NUMBERS, ARMS, baselined, raw_results, reference_dates, steady, subjects, table, with_views
from subjectflow.plans.registry import query

# ------------------------------------------------------------------- time to event
_TTE = """, ev AS (SELECT usubjid, arg_min(seq, (adt, seq)) AS srcseq, MIN(adt) AS adt FROM results
          WHERE paramcd = 'error' AND aval > 100 AND adt >= trtsdt GROUP BY 1),
      cs AS (SELECT usubjid, MAX(adt) AS adt FROM results GROUP BY 1),
      tte AS (SELECT t.usubjid, t.trtsdt AS startdt, greatest(coalesce(ev.adt, cs.adt), t.trtsdt) AS adt,
          CASE WHEN ev.adt IS NULL THEN 1 ELSE 0 END AS cnsr, CASE WHEN ev.adt IS NULL THEN 'Last record' ELSE 'First error' END AS evntdesc,
          ev.srcseq
        FROM trtref t JOIN cs USING (usubjid) LEFT JOIN ev USING (usubjid)),
      timed AS (SELECT *, CAST(adt - startdt + 1 AS INTEGER) AS aval FROM tte),
      anl AS (SELECT t.*, arm FROM timed t JOIN subject USING (usubjid) WHERE arm IN ('Placebo', 'Low Dose', 'High Dose'))"""


def tte(spark, sf_dir):
    ref = reference_dates(spark, sf_dir)
    rows = raw_results(spark, sf_dir).drop("props", "ts")
    # Only the few candidate events need the reference date.
    errors = rows.filter("paramcd = 'error' AND aval > 100")
    errors = merges.merge_vars(errors, ref, ["usubjid"], ["trtsdt"], unique=True)
    first = F.min(F.struct("adt", "seq")).alias("_m")
    errors = errors.filter("adt >= trtsdt").groupBy("usubjid").agg(first).select("usubjid", "_m.*")
    last = rows.groupBy("usubjid").agg(F.max("adt").alias("lastdt"))
    events = [survival.EventSource("errors", "adt", values={"EVNTDESC": "First error", "SRCSEQ": F.col("seq")})]
    censors = [survival.CensorSource("last", "lastdt", values={"EVNTDESC": "Last record", "SRCSEQ": F.lit(None).cast("long")})]
    out = survival.time_to_event(ref, "trtsdt", events, censors, {"errors": errors, "last": last}, ["usubjid"])
    from subjectflow.functions.dates import duration

    return out.withColumn("AVAL", duration("STARTDT", "ADT"))


def analysed_times(spark, sf_dir):
    """Event times joined to the treated arms."""
    s = subjects(spark, sf_dir).filter(F.col("arm").isin(ARMS)).select("usubjid", "arm")
    return s.join(tte(spark, sf_dir).select("usubjid", "AVAL", "CNSR"), "usubjid", "inner")


@query("time_to_event", with_views("subject results", _TTE + " SELECT usubjid, startdt, adt, cnsr, evntdesc, srcseq, aval FROM timed"))
def time_to_event(spark, sf_dir):
    """First qualifying event, else the last record, per subject."""
    return tte(spark, sf_dir).select(
        "usubjid", F.col("STARTDT").alias("startdt"), F.col("ADT").alias("adt"), F.col("CNSR").alias("cnsr"),
        F.col("EVNTDESC").alias("evntdesc"), F.col("SRCSEQ").alias("srcseq"), F.col("AVAL").alias("aval"),
    )


@query(
    "km_curve",
    with_views("subject results", _TTE + """,
      byday AS (SELECT arm, aval AS time, COUNT(*) FILTER (cnsr = 0) AS d, COUNT(*) FILTER (cnsr <> 0) AS c FROM anl GROUP BY 1, 2),
      risk AS (SELECT *, CAST(SUM(d + c) OVER (PARTITION BY arm ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS n FROM byday),
      surv AS (SELECT *, product(1.0 - CAST(d AS DOUBLE) / n) OVER w AS s,
          sqrt(SUM(CAST(d AS DOUBLE) / (n * CAST(nullif(n - d, 0) AS DOUBLE))) OVER w) AS e FROM risk
        WINDOW w AS (PARTITION BY arm ORDER BY time ROWS UNBOUNDED PRECEDING))
      SELECT arm, time, n AS n_risk, d AS n_event, c AS n_censor, round(s + 3e-10, 6) AS surv,
        CASE WHEN s > 0 THEN round(e + 3e-10, 6) END AS std_err,
        CASE WHEN s > 0 THEN round(s / exp(1.959963984540054 * e) + 3e-10, 6) END AS lower,
        CASE WHEN s > 0 THEN round(least(1.0, s * exp(1.959963984540054 * e)) + 3e-10, 6) END AS upper
      FROM surv"""),
)
def km_curve(spark, sf_dir):
    """Kaplan-Meier curve by arm with log confidence limits."""
    curve = survival.km_curve(analysed_times(spark, sf_dir), "arm")
    return curve.select("arm", "time", "n_risk", "n_event", "n_censor",
                        *[steady(c).alias(c) for c in ("surv", "std_err", "lower", "upper")])


@query(
    "km_risk_table",
    with_views("subject results", _TTE + """
      SELECT arm, t AS time, COUNT(*) FILTER (aval >= t) AS n_risk
      FROM anl, (VALUES (0), (5), (10), (15), (20), (25), (30)) x(t) GROUP BY 1, 2"""),
)
def km_risk_table(spark, sf_dir):
    """Number at risk by arm at fixed times."""
    return survival.risk_table(analysed_times(spark, sf_dir), "arm", range(0, 31, 5))


# ------------------------------------------------------------------- summaries
_ARM_ROWS = """, a AS (SELECT b.*, arm, armn, siteid, CASE WHEN ablfl IS NULL THEN aval - base END AS chg
        FROM based b JOIN subject USING (usubjid) WHERE arm IN ('Placebo', 'Low Dose', 'High Dose'))"""


def arm_rows(spark, sf_dir):
    """Results with baseline, change and the subject's arm and site."""
    b = baselined(spark, sf_dir)
    s = subjects(spark, sf_dir).filter(F.col("arm").isin(ARMS)).select("usubjid", "arm", "armn", "siteid")
    b = b.withColumn("chg", F.when(F.col("ablfl").isNull(), longitudinal.change("aval", "base")))
    return b.join(s, "usubjid", "inner")


@query(
    "visit_summary",
    with_views("subject based", _ARM_ROWS + """
      SELECT arm, paramcd, avisitn, COUNT(*) AS n, round(AVG(chg) + 3e-10, 6) AS mean_chg, round(STDDEV_SAMP(chg) + 3e-10, 6) AS sd_chg,
        round(AVG(aval) + 3e-10, 6) AS mean, round(STDDEV_SAMP(aval) + 3e-10, 6) AS sd,
        CASE WHEN COUNT(base) = COUNT(*) THEN round(AVG(base) + 3e-10, 6) END AS mean_bl
      FROM a WHERE avisitn > 0 AND (chg IS NOT NULL OR paramcd = 'view') GROUP BY 1, 2, 3"""),
)
def visit_summary(spark, sf_dir):
    """Counts, means and deviations per arm, parameter and visit."""
    from subjectflow.functions.cells import mean_or_null

    rows = arm_rows(spark, sf_dir).withColumnRenamed("AVISITN", "avisitn")
    stats = {
        "n": F.count("*"), "mean_chg": steady(F.avg("chg")), "sd_chg": steady(F.stddev_samp("chg")),
        "mean": steady(F.avg("aval")), "sd": steady(F.stddev_samp("aval")), "mean_bl": steady(mean_or_null("base")),
    }
    where = (F.col("avisitn") > 0) & (F.col("chg").isNotNull() | (F.col("paramcd") == "view"))
    return summary.grouped_summary(rows, ["arm", "paramcd", "avisitn"], stats, where)


_LAYERS = """, layers AS (SELECT 1 AS layer_no, 'Baseline' AS layer, arm, aval AS value FROM a WHERE avisitn = 0
        UNION ALL SELECT 2, 'Week 3', arm, aval FROM a WHERE avisitn = 3
        UNION ALL SELECT 3, 'Change from Baseline', arm, chg FROM a WHERE avisitn = 3),
      st AS (SELECT layer_no, layer, arm, COUNT(value) AS n, AVG(value) AS mean, STDDEV_SAMP(value) AS sd, MEDIAN(value) AS median,
          MIN(value) AS min, MAX(value) AS max FROM layers WHERE value IS NOT NULL GROUP BY 1, 2, 3)"""


def layer_stats(spark, sf_dir):
    rows = arm_rows(spark, sf_dir)
    layers = [
        ("Baseline", "aval", F.col("AVISITN") == 0),
        ("Week 3", "aval", F.col("AVISITN") == 3),
        ("Change from Baseline", "chg", F.col("AVISITN") == 3),
    ]
    return summary.layered_summary(rows, "arm", ARMS, layers)


@query(
    "layered_summary",
    with_views("subject based", _ARM_ROWS + _LAYERS + """
      SELECT layer_no, layer, arm, n, round(mean + 3e-10, 6) AS mean, round(sd + 3e-10, 6) AS sd, round(median + 3e-10, 6) AS median,
        round(min + 3e-10, 6) AS min, round(max + 3e-10, 6) AS max FROM st"""),
)
def layered_summary(spark, sf_dir):
    """The same statistics over three layers, per arm."""
    s = layer_stats(spark, sf_dir)
    return s.select("layer_no", "layer", "arm", "n", *[steady(c).alias(c) for c in ("mean", "sd", "median", "min", "max")])


def _cells(label: str, no: int, text: str) -> str:
    arms = ", ".join(
        f"coalesce(max(CASE WHEN arm = '{a}' THEN {text} END), '') AS \"var1_{a}\"" for a in ARMS
    )
    return f"SELECT layer_no AS ord_layer_index, 1 AS ord_layer_1, {no} AS ord_layer_2, '{label}' AS row_label, {arms} FROM st GROUP BY layer_no"


@query(
    "nest_rowlabels",
    with_views("subject based", _ARM_ROWS + _LAYERS + f"""
      {_cells("n", 1, "printf('%2d', n)")}
      UNION ALL {_cells("Mean (SD)", 2, "printf('%4.1f (%5.2f)', mean, sd)")}
      UNION ALL {_cells("Range", 3, "printf('%3.0f;%3.0f', min, max)")}
      UNION ALL SELECT DISTINCT layer_no, 0, 0, layer, '', '', '' FROM st"""),
)
def nest_rowlabels(spark, sf_dir):
    """Report rows per layer and statistic with a stub row above each layer."""
    rows = summary.stat_rows(layer_stats(spark, sf_dir), "arm", ARMS, [
        ("n", formats.masked("xx", "n")),
        ("Mean (SD)", formats.masked("xx.x (xx.xx)", "mean", "sd")),
        ("Range", formats.masked("xxx;xxx", "min", "max")),
    ])
    rows = rows.withColumnsRenamed({"layer_no": "ord_layer_index", "layer": "row_label1"}).withColumn("ord_layer_1", F.lit(1))
    return summary.nest_row_labels(rows)


# ------------------------------------------------------------------- models
def _t_p(t: str, df: str) -> str:
    """SQL for the two-sided p-value of a t statistic with whole df: a finite sum of cosine powers."""
    angle = f"atan(abs({t}) / sqrt({df}))"
    even = f"coalesce(list_sum(list_transform(range(0, {df} // 2), lambda j: exp(lgamma(2 * j + 1) - 2 * lgamma(j + 1) - j * ln(4) + 2 * j * ln(cos({angle}))))), 0)"
    odd = f"coalesce(list_sum(list_transform(range(0, ({df} - 1) // 2), lambda j: exp(j * ln(4) + 2 * lgamma(j + 1) - lgamma(2 * j + 2) + (2 * j + 1) * ln(cos({angle}))))), 0)"
    return f"(1 - CASE WHEN {df} % 2 = 0 THEN sin({angle}) * {even} ELSE 2 / pi() * ({angle} + sin({angle}) * {odd}) END)"


def _critical(rows: str) -> str:
    """SQL views: ``q`` has the 95 % two-sided t quantile of each df in ``rows``, by bisection."""
    mid = "(lo + hi) / 2"
    outside = f"{_t_p(mid, 'df')} > 0.05"
    return f""", bis AS (SELECT DISTINCT df, CAST(0 AS DOUBLE) AS lo, CAST(64 AS DOUBLE) AS hi, 0 AS k FROM {rows}
        UNION ALL SELECT df, CASE WHEN {outside} THEN {mid} ELSE lo END, CASE WHEN {outside} THEN hi ELSE {mid} END, k + 1 FROM bis WHERE k < 60),
      q AS (SELECT df, lo AS q FROM bis WHERE k = 60)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


_TWO_ARM = """, d AS (SELECT arm, base AS x, chg AS y FROM a WHERE paramcd = 'purchase' AND avisitn = 2
          AND arm IN ('Placebo', 'High Dose') AND base IS NOT NULL AND chg IS NOT NULL),
      c AS (SELECT arm, COUNT(*) AS n, AVG(x) AS mx, AVG(y) AS my, VAR_POP(x) * COUNT(*) AS sxx,
          COVAR_POP(x, y) * COUNT(*) AS sxy, VAR_POP(y) * COUNT(*) AS syy FROM d GROUP BY arm),
      t AS (SELECT SUM(n) AS n, SUM(n * mx) / SUM(n) AS xbar, SUM(sxy) / SUM(sxx) AS b, SUM(sxx) AS sxx,
          SUM(syy) - SUM(sxy) / SUM(sxx) * SUM(sxy) AS sse FROM c),
      m AS (SELECT h.n AS n1, p.n AS n2, b, CAST(t.n - 3 AS BIGINT) AS df, sse, t.n AS n, t.sxx AS sxx, xbar,
          h.mx AS x1, p.mx AS x2, h.my AS y1, p.my AS y2, sse / (t.n - 3) AS s2
        FROM t, (SELECT * FROM c WHERE arm = 'High Dose') h, (SELECT * FROM c WHERE arm = 'Placebo') p)
"""
_TWO_ARM_ROWS = """      SELECT n1, n2, round(b + 3e-10, 6) AS slope, df, round(y1 - b * (x1 - xbar) + 3e-10, 6) AS lsmean1,
        round(sqrt(s2 * (1.0 / n1 + (x1 - xbar) * (x1 - xbar) / sxx)) + 3e-10, 6) AS se1, round(y2 - b * (x2 - xbar) + 3e-10, 6) AS lsmean2,
        round(sqrt(s2 * (1.0 / n2 + (x2 - xbar) * (x2 - xbar) / sxx)) + 3e-10, 6) AS se2, round(y1 - y2 - b * (x1 - x2) + 3e-10, 6) AS diff,
        round(sqrt(s2 * (1.0 / n1 + 1.0 / n2 + (x1 - x2) * (x1 - x2) / sxx)) + 3e-10, 6) AS diff_se, round(sqrt(sse / n) + 3e-10, 6) AS rmse
      FROM m"""


def two_arm_rows(spark, sf_dir):
    return arm_rows(spark, sf_dir).filter("paramcd = 'purchase' AND AVISITN = 2 AND arm IN ('Placebo', 'High Dose')")


def two_arm_fit(spark, sf_dir):
    return models.ancova_two_arm(two_arm_rows(spark, sf_dir), "chg", "base", "arm", ["High Dose", "Placebo"])


@query("ancova_two_arm", with_views("subject based", _ARM_ROWS + _TWO_ARM + _TWO_ARM_ROWS))
def ancova_two_arm(spark, sf_dir):
    """Fit of change on baseline and arm for two arms: LS means, difference, errors."""
    fit = two_arm_fit(spark, sf_dir)
    return fit.select("n1", "n2", "df", *[
        steady(c).alias(c) for c in ("slope", "lsmean1", "se1", "lsmean2", "se2", "diff", "diff_se", "rmse")
    ])


@query(
    "ancova_two_arm_report",
    _recursive(with_views("subject based", _ARM_ROWS + _TWO_ARM + _critical("m") + """, l AS (
        SELECT 'High Dose' AS arm, n1 AS n, y1 - b * (x1 - xbar) AS e, sqrt(s2 * (1.0 / n1 + (x1 - xbar) * (x1 - xbar) / sxx)) AS se, df FROM m
        UNION ALL SELECT 'Placebo', n2, y2 - b * (x2 - xbar), sqrt(s2 * (1.0 / n2 + (x2 - xbar) * (x2 - xbar) / sxx)), df FROM m)
      SELECT arm, n, printf('%5.2f (%5.2f,%5.2f)', e, e - q * se, e + q * se) AS ls_mean_ci FROM l JOIN q USING (df)""")),
)
def ancova_two_arm_report(spark, sf_dir):
    """LS mean rows with t limits, as report text."""
    rows = models.ancova_two_arm_report(two_arm_fit(spark, sf_dir), ["High Dose", "Placebo"])
    return rows.select("arm", "n", formats.fmt_ci("lsmean", "lower", "upper").alias("ls_mean_ci"))


@query(
    "ancova_two_arm_pairwise",
    with_views("subject based", _ARM_ROWS + _TWO_ARM + f""", l AS (
        SELECT y1 - y2 - b * (x1 - x2) AS e, sqrt(s2 * (1.0 / n1 + 1.0 / n2 + (x1 - x2) * (x1 - x2) / sxx)) AS se, df, sqrt(sse / n) AS rmse FROM m),
      v AS (SELECT *, {_t_p("(e / se)", "df")} AS p FROM l)
      SELECT printf('%5.2f (%5.2f,%5.2f)', e, e - 1.96 * se, e + 1.96 * se) AS difference_ci,
        CASE WHEN p < 0.001 THEN '<0.001' ELSE printf('%7.3f', p) END AS p, printf('%.2f', rmse) AS rmse FROM v"""),
)
def ancova_two_arm_pairwise(spark, sf_dir):
    """Pairwise difference with 1.96 limits and t-test p-value, as report text."""
    rows = models.pairwise_report(two_arm_fit(spark, sf_dir))
    return rows.select(formats.fmt_ci("estimate", "lower", "upper").alias("difference_ci"), formats.fmt_pval("p_value").alias("p"),
                       formats.fixed("rmse", 2).alias("rmse"))


_FACTOR = """, d AS (SELECT arm, armn, siteid, base AS x, chg AS y FROM a WHERE paramcd = 'error' AND avisitn = 3
          AND base IS NOT NULL AND chg IS NOT NULL),
      ctr AS (SELECT x - AVG(x) OVER w AS x, y - AVG(y) OVER w AS y, armn - AVG(armn) OVER w AS z,
          (arm = 'High Dose')::INT - AVG((arm = 'High Dose')::INT) OVER w AS h,
          (arm = 'Low Dose')::INT - AVG((arm = 'Low Dose')::INT) OVER w AS l
        FROM d WINDOW w AS (PARTITION BY siteid)),
      s AS (SELECT SUM(x*x) xx, SUM(x*y) xy, SUM(y*y) yy, SUM(z*z) zz, SUM(z*x) zx, SUM(z*y) zy, SUM(h*h) hh, SUM(h*l) hl, SUM(h*x) hx,
          SUM(h*y) hy, SUM(l*l) ll, SUM(l*x) lx, SUM(l*y) ly, COUNT(*) AS n FROM ctr),
      k AS (SELECT COUNT(DISTINCT siteid) AS sites FROM d),
      m1 AS (SELECT (zy*xx - zx*xy) / (zz*xx - zx*zx) AS bz, (zz*xy - zx*zy) / (zz*xx - zx*zx) AS bx, xx / (zz*xx - zx*zx) AS vz,
          zy, xy, yy, n - sites - 2 AS df FROM s, k),
      det AS (SELECT *, hh*(ll*xx - lx*lx) - hl*(hl*xx - lx*hx) + hx*(hl*lx - ll*hx) AS dd, n - sites - 3 AS df FROM s, k),
      inv AS (SELECT *, (ll*xx - lx*lx)/dd AS ihh, (hx*lx - hl*xx)/dd AS ihl, (hl*lx - hx*ll)/dd AS ihx, (hh*xx - hx*hx)/dd AS ill,
          (hx*hl - hh*lx)/dd AS ilx, (hh*ll - hl*hl)/dd AS ixx FROM det),
      bet AS (SELECT *, ihh*hy + ihl*ly + ihx*xy AS bh, ihl*hy + ill*ly + ilx*xy AS bl, ihx*hy + ilx*ly + ixx*xy AS bx FROM inv),
      fit AS (SELECT *, (yy - bh*hy - bl*ly - bx*xy) / df AS s2 FROM bet),
      r AS (SELECT 'dose' AS test, bz AS e, sqrt((yy - bz*zy - bx*xy) / df * vz) AS se, CAST(df AS BIGINT) AS df FROM m1
        UNION ALL SELECT 'Hi - Lo', bh - bl, sqrt(s2 * (ihh - 2*ihl + ill)), df FROM fit
        UNION ALL SELECT 'Hi - Pbo', bh, sqrt(s2 * ihh), df FROM fit UNION ALL SELECT 'Lo - Pbo', bl, sqrt(s2 * ill), df FROM fit)"""
_FACTOR_ROWS = _critical("r") + f"""
      SELECT test, round(e + 3e-10, 6) AS estimate, round(se + 3e-10, 6) AS se, df, round({_t_p("(e / se)", "df")} + 3e-10, 6) AS p_value,
        round(e - q * se + 3e-10, 6) AS lower, round(e + q * se + 3e-10, 6) AS upper FROM r JOIN q USING (df)"""
_FACTOR_WITHOUT = """, d AS (SELECT arm, armn, siteid, chg AS y FROM a WHERE paramcd = 'error' AND avisitn = 3 AND chg IS NOT NULL),
      ctr AS (SELECT y - AVG(y) OVER w AS y, armn - AVG(armn) OVER w AS z, (arm = 'High Dose')::INT - AVG((arm = 'High Dose')::INT) OVER w AS h,
          (arm = 'Low Dose')::INT - AVG((arm = 'Low Dose')::INT) OVER w AS l FROM d WINDOW w AS (PARTITION BY siteid)),
      s AS (SELECT SUM(y*y) yy, SUM(z*z) zz, SUM(z*y) zy, SUM(h*h) hh, SUM(h*l) hl, SUM(h*y) hy, SUM(l*l) ll, SUM(l*y) ly,
          COUNT(*) - (SELECT COUNT(DISTINCT siteid) FROM d) AS free FROM ctr),
      inv AS (SELECT *, ll / (hh*ll - hl*hl) AS ihh, -hl / (hh*ll - hl*hl) AS ihl, hh / (hh*ll - hl*hl) AS ill FROM s),
      fit AS (SELECT *, ihh*hy + ihl*ly AS bh, ihl*hy + ill*ly AS bl, free - 2 AS df FROM inv),
      r AS (SELECT 'dose' AS test, zy / zz AS e, sqrt((yy - zy / zz * zy) / (free - 1) / zz) AS se, CAST(free - 1 AS BIGINT) AS df FROM s
        UNION ALL SELECT 'Hi - Lo', bh - bl, sqrt((yy - bh*hy - bl*ly) / df * (ihh - 2*ihl + ill)), df FROM fit
        UNION ALL SELECT 'Hi - Pbo', bh, sqrt((yy - bh*hy - bl*ly) / df * ihh), df FROM fit
        UNION ALL SELECT 'Lo - Pbo', bl, sqrt((yy - bh*hy - bl*ly) / df * ill), df FROM fit)"""


def factor_fit(spark, sf_dir, covariate="base"):
    rows = arm_rows(spark, sf_dir).filter("paramcd = 'error' AND AVISITN = 3")
    arms = ["High Dose", "Low Dose", "Placebo"]
    return models.ancova_factor(
        rows, "chg", "arm", arms, [ARM_NUMBERS[a] for a in arms], ["Hi", "Lo", "Pbo"], "siteid", covariate
    )


def _factor_rows(fit):
    return fit.select("test", "df", *[steady(c).alias(c) for c in ("estimate", "se", "p_value", "lower", "upper")])


@query("ancova_factor", _recursive(with_views("subject based", _ARM_ROWS + _FACTOR + _FACTOR_ROWS)))
def ancova_factor(spark, sf_dir):
    """Dose slope and pairwise contrasts with site absorbed and baseline as covariate."""
    return _factor_rows(factor_fit(spark, sf_dir))


@query("ancova_factor_nocov", _recursive(with_views("subject based", _ARM_ROWS + _FACTOR_WITHOUT + _FACTOR_ROWS)))
def ancova_factor_nocov(spark, sf_dir):
    """The same contrasts without a covariate."""
    return _factor_rows(factor_fit(spark, sf_dir, None))


def _number_sql(expression: str, digits: int, size: int, int_len: int) -> str:
    """Text of a number on its decimal point, padded on the right; no sign before a zero."""
    text = f"printf('%{int_len + digits + 1}.{digits}f', {expression})"
    text = f"CASE WHEN CAST(trim({text}) AS DOUBLE) = 0 THEN printf('%{int_len + digits + 1}.{digits}f', abs({expression})) ELSE {text} END"
    return f"rpad({text}, CAST(greatest({size}, length({text})) AS INTEGER), ' ')"


_FACTOR_REPORT = _critical("r") + f""", v AS (SELECT test, e, se, {_t_p("(e / se)", "df")} AS p, e - q * se AS lo, e + q * se AS hi FROM r JOIN q USING (df)),
      t AS (SELECT test, {_number_sql("p", 3, 12, 4)} AS p, {_number_sql("e", 1, 4, 2)} || ' (' || {_number_sql("se", 2, 4, 1)} || ')' AS d,
          '(' || {_number_sql("lo", 1, 4, 2)} || ';' || {_number_sql("hi", 1, 3, 1)} || ')' AS c FROM v),
      g AS (SELECT -1 AS ord, 'High Dose' AS arm, p AS txt FROM t WHERE test = 'dose'
        UNION ALL SELECT 0, 'High Dose', '' FROM t WHERE test = 'dose'
        UNION ALL SELECT x.ord, b.arm, CASE (x.ord - 1) % 4 WHEN 0 THEN p WHEN 1 THEN d WHEN 2 THEN c ELSE '' END
          FROM t JOIN (VALUES ('Lo - Pbo', 'Low Dose', 1, 4), ('Hi - Pbo', 'High Dose', 1, 4), ('Hi - Lo', 'High Dose', 5, 7)) b(test, arm, a, z) USING (test)
          JOIN (SELECT unnest(range(1, 8)) AS ord) x ON x.ord BETWEEN b.a AND b.z)
      SELECT CAST(ord AS INTEGER) AS ord, CASE ord WHEN -1 THEN 'p-value(Dose Response) [1][2]' WHEN 1 THEN 'p-value(Xan - Placebo) [1][3]' WHEN 5 THEN 'p-value(Xan High - Xan Low) [1][3]'
          WHEN 2 THEN '  Diff of LS Means (SE)' WHEN 6 THEN '  Diff of LS Means (SE)' WHEN 3 THEN '  95% CI' WHEN 7 THEN '  95% CI' ELSE '' END AS row_label,
        coalesce(max(txt) FILTER (arm = 'Low Dose'), '') AS "var1_Low Dose", coalesce(max(txt) FILTER (arm = 'High Dose'), '') AS "var1_High Dose"
      FROM g GROUP BY ord"""


@query("ancova_factor_report", _recursive(with_views("subject based", _ARM_ROWS + _FACTOR + _FACTOR_REPORT)))
def ancova_factor_report(spark, sf_dir):
    """Model rows as label x arm report text."""
    from subjectflow.plans.reports import efficacy_rows

    names = {"Lo - Pbo": ("Low Dose", 1), "Hi - Pbo": ("High Dose", 1), "Hi - Lo": ("High Dose", 5)}
    return efficacy_rows(factor_fit(spark, sf_dir), names, "High Dose", ["Low Dose", "High Dose"])


@query(
    "linear_two_arm",
    with_views("subject based", _ARM_ROWS + _TWO_ARM + """
      SELECT round(b + 3e-10, 6) AS slope, round(y1 - y2 - b * (x1 - x2) + 3e-10, 6) AS diff,
        round(sqrt(s2 * (1.0 / n1 + 1.0 / n2 + (x1 - x2) * (x1 - x2) / sxx)) + 3e-10, 6) AS diff_se, df, round(sqrt(sse / n) + 3e-10, 6) AS rmse FROM m"""),
)
def linear_two_arm(spark, sf_dir):
    """Change on baseline and one arm, as a call of the general model: the numbers of the two-arm analysis."""
    rows = two_arm_rows(spark, sf_dir)
    fitted = linear.linear_model(rows, "chg", {"base": F.col("base"), "high": (F.col("arm") == "High Dose").cast("double")})
    of = lambda term, c: F.max(F.when(F.col("term") == term, F.col(c)))
    out = fitted.agg(
        of("base", "estimate").alias("slope"), of("high", "estimate").alias("diff"), of("high", "se").alias("diff_se"), F.max("df").alias("df"), F.max("rmse").alias("rmse"),
    )
    return out.select(*[steady(c).alias(c) for c in ("slope", "diff", "diff_se", "rmse")], "df")


_LINES = """WITH d AS (SELECT l_suppkey AS g, l_quantity AS a, l_discount * 100 AS b, l_tax * 100 AS c, l_extendedprice / 1000 AS y FROM lineitem),
      {centred},
      s AS (SELECT sum(a*a) aa, sum(a*b) ab, sum(a*c) ac, sum(b*b) bb, sum(b*c) bc, sum(c*c) cc, sum(a*y) ay, sum(b*y) "by", sum(c*y) cy, sum(y*y) yy,
        count(*) - {levels} - 3 AS df, any_value(ma) AS ma, any_value(mb) AS mb, any_value(mc) AS mc, any_value(my) AS my, count(*) AS n FROM k),
      i AS (SELECT *, aa*(bb*cc - bc*bc) - ab*(ab*cc - bc*ac) + ac*(ab*bc - bb*ac) AS dd FROM s),
      v AS (SELECT *, (bb*cc - bc*bc)/dd AS iaa, (ac*bc - ab*cc)/dd AS iab, (ab*bc - ac*bb)/dd AS iac, (aa*cc - ac*ac)/dd AS ibb, (ab*ac - aa*bc)/dd AS ibc, (aa*bb - ab*ab)/dd AS icc FROM i),
      e AS (SELECT *, iaa*ay + iab*"by" + iac*cy AS ba, iab*ay + ibb*"by" + ibc*cy AS bb_, iac*ay + ibc*"by" + icc*cy AS bc_ FROM v),
      f AS (SELECT *, (yy - ba*ay - bb_*"by" - bc_*cy) / df AS s2 FROM e)
      SELECT term, round(estimate + 3e-10, 6) AS estimate, round(se + 3e-10, 6) AS se, CAST(df AS BIGINT) AS df, aliased FROM (
        SELECT 'quantity' AS term, ba AS estimate, sqrt(s2*iaa) AS se, df, false AS aliased FROM f
        UNION ALL SELECT 'discount', bb_, sqrt(s2*ibb), df, false FROM f UNION ALL SELECT 'tax', bc_, sqrt(s2*icc), df, false FROM f
        UNION ALL SELECT 'mixed', NULL, NULL, df, true FROM f{more})"""

def _line_model(spark, sf_dir, absorb):
    """Price on quantity, discount, tax and a term that the first and third make up."""
    d = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_quantity").alias("quantity"), (F.col("l_discount") * 100).alias("discount"), (F.col("l_tax") * 100).alias("tax"),
        (F.col("l_extendedprice") / 1000).alias("price"),
    )
    d = d.withColumn("mixed", F.col("quantity") * 2 - F.col("tax"))
    found = linear.linear_model(d, "price", ["quantity", "discount", "tax", "mixed"], absorb)
    return found.select("term", steady("estimate").alias("estimate"), steady("se").alias("se"), "df", "aliased")


@query(
    "linear_three_terms",
    _LINES.format(
        centred="""k AS (SELECT a - ma AS a, b - mb AS b, c - mc AS c, y - my AS y, ma, mb, mc, my FROM d, (SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my FROM d))""",
        levels=1, more="""
        UNION ALL SELECT '(Intercept)', my - ba*ma - bb_*mb - bc_*mc, sqrt(s2 * (1.0 / n + ma*ma*iaa + mb*mb*ibb + mc*mc*icc + 2*(ma*mb*iab + ma*mc*iac + mb*mc*ibc))), df, false FROM f""",
    ),
)
def linear_three_terms(spark, sf_dir):
    """Three covariates and a collinear fourth, which is aliased."""
    return _line_model(spark, sf_dir, None)


@query(
    "linear_absorbed",
    _LINES.format(
        centred="""k AS (SELECT a - avg(a) OVER w AS a, b - avg(b) OVER w AS b, c - avg(c) OVER w AS c, y - avg(y) OVER w AS y, 0 AS ma, 0 AS mb, 0 AS mc, 0 AS my
          FROM d WINDOW w AS (PARTITION BY g))""",
        levels="(SELECT count(DISTINCT g) FROM d)", more="",
    ),
)
def linear_absorbed(spark, sf_dir):
    """The same within suppliers: a factor of many levels is absorbed."""
    return _line_model(spark, sf_dir, "l_suppkey")
