"""The five analysis tables and the reports on a small made-up study."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from subjectflow.plans import analysis_tables as tables
from subjectflow.plans import reports

D = dt.date
SKIN = "SKIN AND SUBCUTANEOUS TISSUE DISORDERS"


@pytest.fixture(scope="module")
def study(spark):
    def frame(rows, schema):
        head = "STUDYID string, USUBJID string, "
        return spark.createDataFrame([("S", *r) for r in rows], head + schema)

    arms = {"u1": "Placebo", "u2": "Xanomeline High Dose", "u3": "Xanomeline Low Dose", "u4": "Screen Failure"}
    dm = frame(
        [(u, "DM", u[1:], "702" if u == "u2" else "701", a, "Scrnfail" if u == "u4" else u, "Scrnfail" if u == "u4" else u, 60 + 10 * i,
          "M", "WHITE", "2013-12-01") for i, (u, a) in enumerate(arms.items())],
        "DOMAIN string, SUBJID string, SITEID string, ARM string, ARMCD string, ACTARMCD string, AGE int, SEX string, RACE string, RFENDTC string",
    )
    ds = frame(
        [("u1", "DISPOSITION EVENT", "COMPLETED", "PROTOCOL COMPLETED", "2013-11-30"), ("u2", "DISPOSITION EVENT", "ADVERSE EVENT", "ADVERSE EVENT", "2013-08-01"),
         ("u3", "DISPOSITION EVENT", "PROTOCOL VIOLATION", "PROTOCOL ENTRY CRITERIA NOT MET", "2013-07-20"), ("u4", "DISPOSITION EVENT", "SCREEN FAILURE", "x", "2013-07-01"),
         ("u1", "OTHER EVENT", "FINAL LAB VISIT", "x", "2013-12-05")],
        "DSCAT string, DSDECOD string, DSTERM string, DSSTDTC string",
    )
    ex = frame(
        [("u1", 1, "PLACEBO", 0.0, "2013-07-05", "2013-07-20"), ("u1", 2, "PLACEBO", 0.0, "2013-07-21", "2013-11-30"),
         ("u2", 1, "XANOMELINE", 54.0, "2013-07-06", "2013-07-10"), ("u2", 2, "XANOMELINE", 81.0, "2013-07-11", None), ("u3", 1, "XANOMELINE", 0.0, "2013-07-07", "2013-07-08")],
        "EXSEQ int, EXTRT string, EXDOSE double, EXSTDTC string, EXENDTC string",
    )
    qs = frame(
        [("u1", 1, "ADAS", "ACTOT", "ADAS-COG(11) Subscore", "9", 9.0, "2013-07-05", 3.0, "BASELINE", "Y"), ("u1", 2, "ADAS", "ACTOT", "ADAS-COG(11) Subscore", "14", 14.0, "2013-09-02", 8.0, "WEEK 8", None),
         ("u1", 3, "ADAS", "ACTOT", "ADAS-COG(11) Subscore", "6", 6.0, "2013-09-25", 9.0, "WEEK 12", None), ("u1", 4, "ADAS", "ACTOT", "ADAS-COG(11) Subscore", "9", 9.0, "2014-01-19", 201.0, "RETRIEVAL", None),
         ("u1", 5, "CIBIC", "CIBIC", "CIBIC", "4", 4.0, "2013-09-02", 8.0, "WEEK 8", None), ("u1", 6, "ADAS", "ACITM01", "Word Recall Task", "3", 3.0, "2013-07-05", 3.0, "BASELINE", "Y"),
         ("u1", 7, "MINI-MENTAL STATE", "MMITM01", "x", "5", 5.0, "2013-07-01", 1.0, "SCREENING 1", None), ("u1", 8, "MINI-MENTAL STATE", "MMITM02", "x", "NA", None, "2013-07-01", 1.0, "SCREENING 1", None),
         ("u2", 9, "ADAS", "ACTOT", "ADAS-COG(11) Subscore", "20", 20.0, "2013-07-06", 3.0, "BASELINE", "Y")],
        "QSSEQ int, QSCAT string, QSTESTCD string, QSTEST string, QSORRES string, QSSTRESN double, QSDTC string, VISITNUM double, VISIT string, QSBLFL string",
    )
    sv = frame(
        [("u1", "SCREENING 1", 1.0, -7, "2013-06-28"), ("u1", "WEEK 8", 8.0, 56, "2013-09-02"), ("u1", "WEEK 26", 13.0, 182, "2014-01-02"), ("u1", "UNSCHEDULED", 201.0, 200, "2014-02-02"),
         ("u2", "SCREENING 1", 1.0, -7, "2013-06-29"), ("u2", "WEEK 2", 4.0, 14, None)],
        "VISIT string, VISITNUM double, VISITDY int, SVSTDTC string",
    )
    vs = frame([("u1", "HEIGHT", 1.0, 170.04), ("u1", "WEIGHT", 3.0, 70.15), ("u1", "WEIGHT", 1.0, 99.0), ("u2", "HEIGHT", 1.0, 160.0)], "VSTESTCD string, VISITNUM double, VSSTRESN double")
    sc = frame([("u1", "EDLEVEL", 12.0), ("u1", "OTHER", 1.0)], "SCTESTCD string, SCSTRESN double")
    mh = frame([("u1", "PRIMARY DIAGNOSIS", "2012-06-28"), ("u1", "OTHER", "2000-01-01")], "MHCAT string, MHSTDTC string")
    ae = frame(
        [("u1", 1, "2013-07-05", "2013-07-07", SKIN, "RASH", "N"), ("u1", 2, "2013-06", None, "GENERAL", "APPLICATION SITE PRURITUS", "N"), ("u1", 3, "2013-08", "2013-10-04", "GENERAL", "APPLICATION SITE PRURITUS", "Y"),
         ("u2", 4, "2013-07-10", None, SKIN, "HYPERHIDROSIS", "N"), ("u2", 5, "2013", "2013-10-04", "CARDIAC", "SYNCOPE", "Y")],
        "AESEQ int, AESTDTC string, AEENDTC string, AEBODSYS string, AEDECOD string, AESER string",
    )
    lb_rows = []
    for seq, (u, visit, num, value, flag) in enumerate([
        ("u1", "SCREENING 1", 1.0, 5.0, "Y"), ("u1", "WEEK 2", 4.0, 5.5, None), ("u1", "WEEK 20", 11.0, 7.0, None), ("u1", "WEEK 24", 12.0, 6.0, None), ("u1", "WEEK 26", 13.0, 9.0, None),
        ("u1", "UNSCHEDULED 1.1", 1.1, 8.0, None), ("u2", "SCREENING 1", 1.0, 4.0, "Y"), ("u2", "WEEK 2", 4.0, None, None), ("u2", "WEEK 4", 5.0, 1.0, None), ("u2", "AMBUL ECG", 5.5, 3.0, None)], start=1):
        lb_rows.append((u, float(seq), "CHEMISTRY", "Glucose", "GLUC", value, str(value), "mmol/L", 4.0, 6.0, flag, "2013-07-05", visit, num))
    lb_rows.append(("u1", 99.0, "HEMATOLOGY", "Other", "OTH", 1.0, "1", "x", 1.0, 2.0, None, "2013-07-05", "WEEK 2", 4.0))
    lb = frame(lb_rows, "LBSEQ double, LBCAT string, LBTEST string, LBTESTCD string, LBSTRESN double, LBSTRESC string, LBSTRESU string, LBSTNRLO double, LBSTNRHI double, LBBLFL string, LBDTC string, VISIT string, VISITNUM double")
    supplb = frame([("u1", " 4", "ENDPOINT", "Y")], "IDVARVAL string, QNAM string, QVAL string")
    adsl = tables.subject_level(dm, ds, ex, qs, sv, vs, sc, mh, race_codes={"WHITE": 1}, reasons={"ADVERSE EVENT": "Adverse Event"}).cache()
    return {"dm": dm, "ds": ds, "qs": qs, "ae": ae, "lb": lb, "supplb": supplb, "adsl": adsl}


def test_subject_level(study):
    rows = {r.USUBJID: r for r in study["adsl"].collect()}
    assert sorted(rows) == ["u1", "u2", "u3"]
    a, b, c = rows["u1"], rows["u2"], rows["u3"]
    assert (a.TRT01P, a.TRT01PN, a.TRT01AN, a.AGEGR1, a.AGEGR1N, a.RACEN) == ("Placebo", 0, 0, "<65", 1, 1)
    assert (a.TRTSDT, a.TRTEDT, a.TRTDURD, a.CUMDOSE, a.AVGDD) == (D(2013, 7, 5), D(2013, 11, 30), 149, 0.0, 0.0)
    # A missing end is the discontinuation date: 5 days at 54 and 22 at 81.
    assert (b.TRTEDT, b.CUMDOSE, b.AVGDD) == (D(2013, 8, 1), 5 * 54 + 22 * 81.0, round((5 * 54 + 22 * 81) / 27, 1))
    assert (c.TRTSDT, c.SAFFL, c.ITTFL, c.EFFFL) == (None, "N", "Y", "N")
    assert (a.SAFFL, a.ITTFL, a.EFFFL, b.EFFFL) == ("Y", "Y", "Y", "N")
    assert (a.COMP8FL, a.COMP16FL, c.COMP8FL, b.COMP8FL) == ("Y", "N", None, "N")
    assert (a.EOSSTT, a.DISCONFL, a.DCSREAS) == ("COMPLETED", None, "")
    assert (b.EOSSTT, b.DISCONFL, b.DSRAEFL, b.DCSREAS) == ("DISCONTINUED", "Y", "Y", "Adverse Event")
    assert c.DCSREAS == "I/E Not Met"
    assert (a.HEIGHTBL, a.WEIGHTBL, a.BMIBL, a.BMIBLGR1, b.BMIBL, b.BMIBLGR1) == (170.0, 70.2, 24.3, "<25", None, None)
    assert (a.EDUCLVL, a.MMSETOT, b.MMSETOT) == (12.0, 5.0, None)
    assert (a.VISIT1DT, a.DISONSDT, a.DURDIS, a.DURDSGR1) == (D(2013, 6, 28), D(2012, 6, 28), 12.0, ">=12")
    assert (a.VISNUMEN, b.VISNUMEN) == (12.0, 4.0)  # visit 13 counts as 12; an undated visit sorts last
    assert (a.SITEGR1, b.SITEGR1) == ("701", "900")


def test_adverse_events(study):
    rows = {r.AESEQ: r for r in tables.adverse_events(study["ae"], study["adsl"]).collect()}
    assert (rows[1].ASTDT, rows[1].ASTDY, rows[1].ADURN, rows[1].ADURU, rows[1].TRTEMFL, rows[1].CQ01NAM) == (D(2013, 7, 5), 1, 3, "DAYS", "Y", "DERMATOLOGIC EVENTS")
    assert (rows[2].ASTDT, rows[2].ASTDY, rows[2].ADURN, rows[2].ADURU, rows[2].TRTEMFL) == (D(2013, 6, 1), -34, None, None, None)
    assert (rows[3].ASTDTM, rows[3].ADURN, rows[3].AOCC02FL) == (dt.datetime(2013, 8, 1), 65, "Y")
    assert (rows[4].CQ01NAM, rows[5].ASTDT, rows[5].TRTEMFL) == (None, None, None)
    flagged = lambda name: sorted(s for s, r in rows.items() if r[name] == "Y")
    assert flagged("AOCCFL") == [1, 4] and flagged("AOCCSFL") == [1, 3, 4] and flagged("AOCCPFL") == [1, 3, 4]
    assert flagged("AOCC01FL") == [1] and flagged("AOCC03FL") == [3] and flagged("AOCC04FL") == [3]


def test_chemistry(study):
    df = tables.chemistry(study["lb"], study["supplb"], study["adsl"], param_codes={"Glucose (mmol/L)": 7}).cache()
    rows = [(r.USUBJID, int(r.LBSEQ), r.AVISIT, r.AVISITN, r.AENTMTFL, r.ANL01FL) for r in df.collect()]
    assert sorted(rows, key=lambda r: (r[1], r[3] or -1)) == [
        ("u1", 1, "Baseline", 0.0, None, None),
        ("u1", 2, "Week 2", 2.0, "", None),
        ("u1", 3, "Week 20", 20.0, "", "Y"),
        ("u1", 4, "Week 24", 24.0, "Y", None),
        ("u1", 4, "End of Treatment", 99.0, "Y", None),
        ("u1", 5, "Week 26", 26.0, None, None),
        ("u1", 6, "", None, None, None),
        ("u2", 7, "Baseline", 0.0, None, None),
        ("u2", 8, "Week 2", 2.0, "", None),
        ("u2", 9, "Week 4", 4.0, "Y", "Y"),
        ("u2", 9, "End of Treatment", 99.0, "Y", "Y"),
    ]
    one = {int(r.LBSEQ): r for r in df.filter("AVISITN is null or AVISITN <> 99").collect()}
    assert (one[2].BASE, one[2].CHG, one[1].CHG, one[2].PARAM, one[2].PARAMN) == (5.0, 0.5, None, "Glucose (mmol/L)", 7)
    assert (one[8].AVAL, one[8].AVALC, one[8].ANRIND, one[9].ANRIND, one[1].BNRIND) == (None, None, "N", "L", "N")
    assert one[2].R2A1LO == 5.5 / 4.0 and one[2].BR2A1HI == 5.0 / 6.0 and one[2].ALBTRVAL == 3.5
    furthest = {(r.USUBJID, int(r.LBSEQ)) for r in df.filter("ANL01FL = 'Y'").collect()}
    assert furthest == {("u1", 3), ("u2", 9)}


def test_time_to_first_event(study):
    adae = tables.adverse_events(study["ae"], study["adsl"])
    rows = {r.USUBJID: r for r in tables.time_to_first_event(study["ds"], study["adsl"], adae).collect()}
    assert (rows["u1"].CNSR, rows["u1"].AVAL, rows["u1"].SRCSEQ, rows["u1"].SRCDOM) == (0, 1, 1.0, "ADAE")
    assert (rows["u2"].CNSR, rows["u2"].ADT, rows["u2"].AVAL, rows["u2"].SRCDOM) == (1, D(2013, 8, 1), 27, "ADSL")
    assert (rows["u3"].CNSR, rows["u3"].AVAL) == (1, None)


def test_scores(study):
    df = tables.scores(study["qs"], study["adsl"]).cache()
    total = [(r.USUBJID, r.QSSEQ, r.AVISITN, r.AVAL, r.DTYPE, r.ANL01FL, r.ADY, r.AWTDIFF, r.CHG)
             for r in df.filter("PARAMCD = 'ACTOT'").orderBy("USUBJID", "AVISITN", "QSSEQ").collect()]
    assert total == [
        ("u1", 1, 0, 9.0, None, "Y", 1, 0, None),
        ("u1", 2, 8, 14.0, None, "Y", 60, 4, 5.0),
        ("u1", 3, 8, 6.0, None, None, 83, 27, -3.0),
        ("u1", 2, 16, 14.0, "LOCF", "Y", 60, 52, 5.0),
        ("u1", 4, 24, 9.0, None, "Y", 199, 31, 0.0),
        ("u2", 9, 0, 20.0, None, "Y", 1, 0, None),
        ("u2", 9, 8, 20.0, "LOCF", "Y", 1, 55, 0.0),
        ("u2", 9, 16, 20.0, "LOCF", "Y", 1, 111, 0.0),
        ("u2", 9, 24, 20.0, "LOCF", "Y", 1, 167, 0.0),
    ]
    first = df.filter("PARAMCD = 'ACTOT' and QSSEQ = 2 and DTYPE = 'LOCF'").first()
    assert (first.PARAM, first.VISIT, first.TRTP, first.AWRANGE, first.AWLO, first.AWU) == ("Adas-Cog(11) Subscore", "WEEK 8", "Placebo", "85-140", 85, "DAYS")
    assert df.filter("PARAMCD = 'ACITM01'").count() == 1


def test_demographics(study):
    rows = {(r.block, r.ord): r for r in reports.demographics(study["adsl"], study="S").collect()}
    assert rows[0, 0]["Placebo"] == "(N=1)"
    assert rows[1, 1]["row_label"] == "Mean (sd)" and rows[1, 2]["Placebo"] == "60.00" and rows[1, 3]["Xanomeline High Dose"] == "70.00 - 70.00"
    assert [rows[3, i]["Placebo"] for i in (1, 2, 3)] == ["1", "0", "0"]
    assert rows[4, 2]["variable_label"] == "Baseline Height (cm)"


@pytest.fixture(scope="module")
def trial(spark):
    """Enough subjects for the models: three arms, two site groups."""
    arms = ["Placebo", "Xanomeline Low Dose", "Xanomeline High Dose"]
    codes = dict(zip(arms, (0, 54, 81)))
    subjects = [("S", f"u{i}", arms[i % 3], codes[arms[i % 3]], f"70{i % 2}") for i in range(60)]
    adsl = spark.createDataFrame([(s, u, a, a, c, g, "Y", "Y", "Y") for s, u, a, c, g in subjects],
                                 "STUDYID string, USUBJID string, TRT01P string, TRT01A string, TRT01PN int, SITEGR1 string, EFFFL string, ITTFL string, SAFFL string")
    scores, labs, times = [], [], []
    for i, (s, u, a, c, g) in enumerate(subjects):
        base = 10.0 + (i * 7) % 13
        chg = ((i * 5) % 11) - 4.0
        scores += [(s, u, a, c, g, "ACTOT", 0, base, base, None, "Y", "Y", "Y"), (s, u, a, c, g, "ACTOT", 24, base + chg, base, chg, "Y", "Y", "Y")]
        labs += [(s, u, a, c, "GLUC", 0.0, base, base, 0.0), (s, u, a, c, "GLUC", 20.0, base + chg, base, chg)]
        times.append((s, u, "TTDE", 10 + i, i % 2))
    adadas = spark.createDataFrame(scores, "STUDYID string, USUBJID string, TRTP string, TRTPN int, SITEGR1 string, PARAMCD string, AVISITN int, AVAL double, BASE double, CHG double, EFFFL string, ITTFL string, ANL01FL string")
    adlbc = spark.createDataFrame(labs, "STUDYID string, USUBJID string, TRTP string, TRTPN int, PARAMCD string, AVISITN double, AVAL double, BASE double, CHG double")
    adtte = spark.createDataFrame(times, "STUDYID string, USUBJID string, PARAMCD string, AVAL int, CNSR int")
    return adsl, adadas, adlbc, adtte


def test_primary_endpoint_layout(trial):
    adsl, adadas, _, _ = trial
    body, header = reports.primary_endpoint(adsl, adadas)
    assert header.first()[0] == "|Placebo\\line(N=20)|Xanomeline\\line Low Dose\\line(N=20)|Xanomeline\\line High Dose\\line(N=20)"
    rows = body.orderBy("section", "ord_layer_index", "ord_layer_1", "ord_layer_2").collect()
    assert [r.row_label for r in rows] == [
        "Baseline", "n", "Mean (SD)", "Median (Range)", "Week 24", "n", "Mean (SD)", "Median (Range)", "Change from Baseline", "n", "Mean (SD)", "Median (Range)",
        "p-value(Dose Response) [1][2]", "", "p-value(Xan - Placebo) [1][3]", "  Diff of LS Means (SE)", "  95% CI", "",
        "p-value(Xan High - Xan Low) [1][3]", "  Diff of LS Means (SE)", "  95% CI",
    ]
    assert rows[1]["var1_Placebo"] == "20" and rows[12]["var1_Xanomeline Low Dose"] == ""
    assert len(rows[12]["var1_Xanomeline High Dose"]) == 12


def test_chemistry_efficacy_and_survival(trial):
    adsl, _, adlbc, adtte = trial
    table, comparison, error = reports.chemistry_efficacy(adsl, adlbc)
    rows = {r.Trt: r for r in table.collect()}
    assert set(rows) == {"Xanomeline High Dose", "Placebo"} and rows["Placebo"].N1 == 20 and rows["Placebo"].N3 == 20
    assert comparison.first().comp == "Xanomeline High Dose vs. Placebo"
    assert error.first().rmse.startswith("Root Mean Squared Error of Change = ")
    curve, risk = reports.survival_by_arm(adsl, adtte, "S")
    assert curve.filter((F.col("TRT01A") == "Placebo") & (F.col("time") == 10)).first().n_risk == 20
    assert {r.n_risk for r in risk.filter("time = 0").collect()} == {20} and risk.count() == 33
