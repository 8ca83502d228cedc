"""Operators on hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from subjectflow.operators import compare, joins, longitudinal, merges, occurrence, picks, ranges, subject, summary, survival

D = dt.date


@pytest.fixture
def visits(spark):
    return spark.createDataFrame(
        [("a", 1, 3.0, "x"), ("a", 2, None, "y"), ("a", 3, 1.0, "z"), ("b", 4, None, "w"), ("c", 5, 2.0, None)],
        "id string, seq int, v double, t string",
    )


def test_pick_row_puts_nulls_last(visits, rows):
    assert rows(picks.pick_row(visits, ["id"], ["v", "seq"]), "id", "seq") == [("a", 3), ("b", 4), ("c", 5)]
    # From the end of the same order the null comes first to hand.
    assert rows(picks.pick_row(visits, ["id"], ["v", "seq"], "last"), "id", "seq") == [("a", 2), ("b", 4), ("c", 5)]
    assert rows(picks.pick_row(visits, ["id"], ["-v", "seq"]), "id", "seq") == [("a", 1), ("b", 4), ("c", 5)]


def test_flag_extreme_marks_one_row_per_group(visits, rows):
    out = picks.flag_extreme(visits, ["id"], ["v"], ["seq"], "fl", where=F.col("v").isNotNull())
    assert out.count() == visits.count()
    assert rows(out.filter("fl = 'Y'"), "id", "seq") == [("a", 3), ("c", 5)]


def test_restrict_passes_other_rows_through(visits, rows):
    out = picks.restrict(visits, lambda df: df.withColumn("n", F.lit(1)), F.col("v") > 1)
    assert rows(out, "seq", "n") == [(1, 1), (2, None), (3, None), (4, None), (5, 1)]


def test_nested_flags_equal_separate_flags(spark, rows):
    data = [(s, n, f"c{n % 3}", f"t{n % 5}", (n * 7 + s) % 11 if n % 13 else None, n % 4 == 0) for s in range(4) for n in range(60)]
    df = spark.createDataFrame(data, "id int, seq int, cls string, term string, d int, ser boolean")
    em = F.col("d") > 2
    flags = {"f1": (0, "em"), "f2": (1, "em"), "f3": (2, "em"), "s1": (0, "se"), "s3": (2, "se")}
    levels = [["id"], ["id", "cls"], ["id", "cls", "term"]]
    conditions = {"em": em, "se": em & F.col("ser")}
    out = picks.flag_first_nested(df, levels, ["d"], ["id", "seq"], conditions, flags)
    want = df
    for name, (level, cond) in flags.items():
        want = picks.flag_extreme(want, levels[level], ["d"], ["id", "seq"], name, where=conditions[cond])
    assert rows(out, "id", "seq", *flags) == rows(want, "id", "seq", *flags)


def test_group_max_flag(visits, rows):
    out = picks.flag_group_max(visits, ["id"], "v", "fl")
    assert rows(out, "seq", "fl") == [(1, "Y"), (2, None), (3, ""), (4, None), (5, "Y")]


def test_number_rows_is_contiguous(spark):
    df = spark.range(1000).withColumn("k", (F.col("id") * 37) % 1000).repartition(7)
    got = [tuple(r) for r in picks.number_rows(df, ["k"]).select("row_no", "k").orderBy("row_no").collect()]
    assert got == [(i + 1, i) for i in range(1000)]


def test_merge_vars_keeps_rows_and_checks_keys(spark, visits, rows):
    add = spark.createDataFrame([("a", 1), ("b", 2)], "id string, w int")
    assert rows(merges.merge_vars(visits, add, ["id"], {"new": "w"}), "seq", "new") == [(1, 1), (2, 1), (3, 1), (4, 2), (5, None)]
    with pytest.raises(Exception, match="duplicate key"):
        merges.merge_vars(visits, visits, ["id"], {"new": "t"}).collect()


def test_supp_keys_are_cast(spark, rows):
    parent = spark.createDataFrame([("u", 1.0), ("u", 12.0), ("v", 1.0)], "id string, seq double")
    supp = spark.createDataFrame([("u", "   1", "ENDPOINT", "Y"), ("u", "  12", "OTHER", "x"), ("v", "9", "ENDPOINT", "Y")], "id string, IDVARVAL string, QNAM string, QVAL string")
    assert rows(merges.join_supp(parent, supp, ["id"], ["ENDPOINT"], "seq"), "id", "seq", "ENDPOINT") == [("u", 1.0, "Y"), ("u", 12.0, None), ("v", 1.0, None)]


def test_predecessors(spark, rows):
    qs = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3)], "id string, seq int")
    sl = spark.createDataFrame([("a", 60), ("b", 70)], "id string, age int")
    out = merges.build_predecessors({"QS": qs, "SL": sl}, {"id": ("QS", "id"), "age": ("SL", "age"), "qseq": ("QS", "seq")}, "QS", ["id"])
    assert out.columns == ["id", "age", "qseq"]
    assert rows(out) == [("a", 60, 1), ("a", 60, 2), ("c", None, 3)]


def test_ranges(spark, rows):
    df = spark.createDataFrame([(64,), (65,), (80,), (81,), (None,)], "age int")
    out = ranges.range_category(df, "age", ["<65", "65-80", ">80"], "g", "n")
    assert rows(out) == [(64, "<65", 1), (65, "65-80", 2), (80, "65-80", 2), (81, ">80", 3), (None, None, None)]
    half = ranges.range_category(df, "age", ["64-<80", ">=80"], "g")
    assert rows(half)[:4] == [(64, "64-<80"), (65, "64-<80"), (80, ">=80"), (81, ">=80")]
    with pytest.raises(ValueError):
        ranges.in_range("age", "old")


SCORE = ranges.windows([("Baseline", 0, "<=1", None, 1, 1), ("Week 8", 8, "2-84", 2, 84, 56), ("Week 16", 16, "85-140", 85, 140, 112), ("Week 24", 24, ">140", 141, None, 168)])


def test_carry_forward_worked_example(spark, rows):
    df = spark.createDataFrame([("s", "T", 1, 9.0, 5015), ("s", "T", 60, 14.0, 5030), ("s", "T", 83, 6.0, 5045), ("s", "T", 199, 9.0, 5060)],
                               "id string, PARAMCD string, ADY int, AVAL double, seq int")
    w = ranges.visit_of_day(df, SCORE)
    flagged = longitudinal.flag_closest(w, ["id", "PARAMCD", "AVISIT"], ["seq"], where=F.col("AVISIT").isNotNull())
    out = longitudinal.locf(flagged, ["id", "PARAMCD"], [(x.number, x.label) for x in SCORE], ["ADY", "seq"], ["seq"], where=F.col("ANL01FL") == "Y")
    assert rows(out, "AVISITN", "AVISIT", "AVAL", "ADY", "seq", "ANL01FL", "DTYPE") == [
        (0, "Baseline", 9.0, 1, 5015, "Y", None),
        (16, "Week 16", 14.0, 60, 5030, None, "LOCF"),
        (24, "Week 24", 9.0, 199, 5060, "Y", None),
        (8, "Week 8", 14.0, 60, 5030, "Y", None),
        (8, "Week 8", 6.0, 83, 5045, None, None),
    ]


def test_carry_forward_needs_an_earlier_value(spark):
    df = spark.createDataFrame([("s", 16, "Week 16", 5.0, 1), ("s", 24, "Week 24", None, 2)], "id string, AVISITN int, AVISIT string, AVAL double, seq int")
    out = longitudinal.locf(df, ["id"], [(x.number, x.label) for x in SCORE], ["seq"], ["seq"])
    added = [tuple(r) for r in out.filter("DTYPE = 'LOCF'").select("AVISITN", "AVAL", "seq").collect()]
    assert added == [(24, 5.0, 1)]


def test_closest_tie_prefers_later_day(spark, rows):
    df = spark.createDataFrame([(1, 50), (2, 62)], "seq int, ADY int").withColumn("id", F.lit("s"))
    w = ranges.visit_of_day(df, SCORE)
    out = longitudinal.flag_closest(w, ["id", "AVISIT"], ["seq"])
    assert rows(out.filter("ANL01FL = 'Y'"), "seq") == [(2,)]


def test_baseline_and_changes(spark, rows):
    df = spark.createDataFrame([("s", 1, 0.0, "Y"), ("s", 2, 4.0, None), ("t", 3, -2.0, "Y"), ("t", 4, 1.0, None), ("u", 5, 1.0, None)], "id string, seq int, AVAL double, ABLFL string")
    out = longitudinal.baseline(df, ["id"], "AVAL", "BASE").select("seq", "BASE", longitudinal.change(), longitudinal.percent_change())
    assert rows(out) == [(1, 0.0, 0.0, None), (2, 0.0, 4.0, None), (3, -2.0, 0.0, 0.0), (4, -2.0, 3.0, 150.0), (5, None, None, None)]
    twice = df.withColumn("ABLFL", F.lit("Y"))
    with pytest.raises(Exception, match="more than one baseline"):
        longitudinal.baseline(twice, ["id"], "AVAL", "BASE").collect()


def test_limits(spark, rows):
    df = spark.createDataFrame([(1, 4.0, 10.0, 20.0), (2, 31.0, 10.0, 20.0), (3, 12.0, 10.0, None), (4, None, 10.0, 20.0), (5, 9.0, None, 20.0)], "seq int, v double, lo double, hi double")
    out = df.select("seq", longitudinal.range_indicator("v", "lo", "hi"), longitudinal.threshold_distance("v", "lo", "hi"))
    assert rows(out) == [(1, "L", 26.0), (2, "H", 26.0), (3, None, None), (4, "N", None), (5, None, None)]


def test_end_of_treatment(spark, rows):
    data = [
        ("a", 1, 4.0, "WEEK 2", None), ("a", 2, 12.0, "WEEK 24", None),  # week 24 is copied
        ("b", 3, 4.0, "WEEK 2", None), ("b", 4, 5.0, "WEEK 4", None), ("b", 5, 13.0, "WEEK 26", None),  # fallback: week 4
        ("c", 6, 1.0, "SCREENING 1", "Y"),  # only a baseline: nothing
        ("d", 7, 6.0, "RETRIEVAL", None),  # not a kept visit
    ]
    df = spark.createDataFrame(data, "id string, seq int, VISITNUM double, VISIT string, ABLFL string")
    named = longitudinal.name_visits(df)
    both, fallback = longitudinal.end_of_treatment(
        named, ["id"], ["seq"], endpoint=F.lit(False), last_visit=F.col("VISITNUM") == 12, after=F.col("VISITNUM") == 13,
        kept=F.col("VISIT").contains("WEEK") | F.col("VISIT").contains("SCREENING"),
    )
    assert rows(both.unionByName(fallback).filter("AENTMTFL = 'Y'"), "id", "seq", "AVISITN") == [("a", 2, 99.0), ("b", 4, 99.0)]
    assert rows(both.filter("AENTMTFL = ''"), "seq", "AVISIT", "AVISITN")[0] == (1, "Week 2", 2.0)
    assert ("c", "Baseline", 0.0) in rows(both, "id", "AVISIT", "AVISITN")
    assert both.filter("id = 'd'").count() == 0


def test_custom_query_precedence(spark, rows):
    skin = "SKIN AND SUBCUTANEOUS TISSUE DISORDERS"
    data = [(1, "COLD SWEAT", skin), (2, "APPLICATION SITE ALOPECIA", skin), (3, "RASH", skin), (4, "RASH", "OTHER"), (5, None, skin)]
    df = spark.createDataFrame(data, "seq int, term string, cls string")
    out = df.select("seq", occurrence.custom_query("term", "cls", ["APPLICATION", "ERYTHEMA"], skin, ["COLD SWEAT", "ALOPECIA"], "Q"))
    assert rows(out) == [(1, None), (2, "Q"), (3, "Q"), (4, None), (5, None)]


def test_treatment_emergent(spark, rows):
    t = D(2020, 1, 5)
    data = [(1, D(2020, 1, 5), None, t), (2, D(2020, 1, 4), None, t), (3, None, D(2020, 1, 1), t), (4, None, None, t), (5, t, None, None)]
    df = spark.createDataFrame(data, "seq int, s date, e date, t date")
    assert rows(df.select("seq", occurrence.treatment_emergent("s", "e", "t"))) == [(1, "Y"), (2, None), (3, None), (4, "Y"), (5, None)]


def test_population_flags(spark, rows):
    data = [(1, "Pbo", D(2020, 1, 1), 2), (2, "Pbo", D(2020, 1, 1), 1), (3, "Pbo", None, None), (4, "Scrnfail", None, None), (5, "", D(2020, 1, 1), 2)]
    df = spark.createDataFrame(data, "id int, armcd string, d date, n int")
    out = subject.population_flag_vars(df, "armcd", "d", "n").select("id", "saffl", "ittfl", "efffl")
    assert rows(out) == [(1, "Y", "Y", "Y"), (2, "Y", "Y", "N"), (3, "N", "Y", "N"), (4, None, None, None), (5, "N", "N", "N")]


def test_site_groups(spark, rows):
    df = spark.createDataFrame([("701", "A"), ("702", "A"), ("701", "B"), ("701", "A"), ("702", "A"), (None, "A")], "site string, arm string")
    assert rows(df.select(subject.site_group("site", ["702"]).alias("g")).distinct()) == [("701",), ("900",), (None,)]
    pooled = subject.pool_small_sites(df.dropna(), "site", "arm", ["A", "B"], "g", smallest=1)
    assert rows(pooled.select("site", "g").distinct()) == [("701", "701"), ("702", "900")]


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0, 5.0, 5.0, 1.0], [-3.0, 0.0, 0.0, 7.5], [1e-9, -1e-9, 1e9, 2.5, 2.5, 2.25], list(map(float, range(-50, 51))), [float("-inf"), 2.0, float("inf")], [1.0, 3.0, float("inf")]])
def test_exact_median(spark, values):
    import statistics

    df = spark.createDataFrame([("g", v) for v in values] + [("g", None), ("h", 4.0)], "g string, value double")
    got = dict(tuple(r) for r in summary.exact_median(df, ["g"]).collect())
    assert got == {"g": statistics.median(values), "h": 4.0}
    assert dict(tuple(r) for r in summary.exact_median(df, ["g"]).collect()) == got


def test_pivots(spark, rows):
    df = spark.createDataFrame([("a", "H", 1.0), ("a", "W", 2.0), ("b", "H", 3.0)], "id string, t string, v double")
    wide = summary.pivot_wide(df, ["id"], "t", ["H", "W"], "v", fill=0.0, pattern="%sBL")
    assert rows(wide, "id", "HBL", "WBL") == [("a", 1.0, 2.0), ("b", 3.0, 0.0)]
    assert rows(summary.pivot_long(wide, ["id"], ["HBL", "WBL"])) == [("a", "HBL", 1.0), ("a", "WBL", 2.0), ("b", "HBL", 3.0), ("b", "WBL", 0.0)]


def test_category_counts_keep_zero_cells(spark, rows):
    df = spark.createDataFrame([("A", "x"), ("A", "z"), ("B", None)], "arm string, c string")
    assert rows(summary.category_counts(df, "arm", ["A", "B"], {"c": ["x", "y"]}), "arm", "level", "n") == [("A", "x", 1), ("A", "y", 0), ("B", "x", 0), ("B", "y", 0)]


def test_nested_rows_and_padding(spark, rows):
    body = spark.createDataFrame([("G1", "n", 1, 1, 1, "5"), ("G1", "Mean", 1, 1, 2, None), ("G2", "n", 2, 1, 1, "6")],
                                 "row_label1 string, row_label2 string, ord_layer_index int, ord_layer_1 int, ord_layer_2 int, var1_A string")
    nested = summary.nest_row_labels(body).orderBy("ord_layer_index", "ord_layer_1", "ord_layer_2")
    assert [(r.row_label, r.var1_A) for r in nested.collect()] == [("G1", ""), ("n", "5"), ("Mean", ""), ("G2", ""), ("n", "6")]
    padded = summary.pad_rows(spark.createDataFrame([(1, "a"), (2, "b")], "ord int, t string"), 2)
    assert rows(padded) == [(1, "a"), (2, "b"), (3, ""), (4, "")]


def test_arm_header(spark):
    df = spark.createDataFrame([("B", 54), ("A", 0), ("A", 0), ("C", 81)], "arm string, n int")
    counts = spark.createDataFrame([("A", 79), ("B", 81), ("C", 74)], "arm string, cnt int")
    assert summary.arm_header(df, "arm", "n", counts, "cnt").first()[0] == "|A\\line(N=79)|B\\line(N=81)|C\\line(N=74)"


def test_time_to_event(spark, rows):
    s = spark.createDataFrame([("a", D(2020, 1, 1)), ("b", D(2020, 1, 10)), ("c", D(2020, 1, 1)), ("d", None)], "id string, st date")
    e = spark.createDataFrame([("a", D(2020, 1, 9), 2), ("a", D(2020, 1, 5), 1), ("b", D(2020, 1, 3), 3)], "id string, d date, seq int")
    c = spark.createDataFrame([("a", D(2020, 2, 1)), ("b", D(2020, 2, 1)), ("c", D(2020, 1, 20)), ("d", D(2020, 1, 20))], "id string, d date")
    out = survival.time_to_event(
        s, "st", [survival.EventSource("e", "d", values={"SRC": "E", "SEQ": F.col("seq")})],
        [survival.CensorSource("c", "d", values={"SRC": "C", "SEQ": F.lit(None).cast("int")})], {"e": e, "c": c}, ["id"],
    )
    assert rows(out, "id", "ADT", "CNSR", "SRC", "SEQ") == [
        ("a", D(2020, 1, 5), 0, "E", 1), ("b", D(2020, 1, 10), 0, "E", 3), ("c", D(2020, 1, 20), 1, "C", None), ("d", None, 1, "C", None),
    ]


def test_km_curve_and_risk(spark):
    data = [("A", 5, 0), ("A", 5, 1), ("A", 8, 0), ("A", 12, 0), ("B", 3, 1)]
    df = spark.createDataFrame(data, "arm string, AVAL int, CNSR int")
    got = {(r.arm, r.time): r for r in survival.km_curve(df, "arm").collect()}
    assert [got["A", t].n_risk for t in (5, 8, 12)] == [4, 2, 1]
    assert [round(got["A", t].surv, 6) for t in (5, 8, 12)] == [0.75, 0.375, 0.0]
    assert got["A", 12].lower is None and got["B", 3].surv == 1.0 and got["B", 3].std_err == 0.0
    assert abs(got["A", 8].std_err - (1 / (4 * 3) + 1 / (2 * 1)) ** 0.5) < 1e-12
    assert got["A", 5].upper == 1.0
    at = {(r.arm, r.time): r.n_risk for r in survival.risk_table(df, "arm", [0, 5, 6, 20]).collect()}
    assert [at["A", t] for t in (0, 5, 6, 20)] == [4, 4, 2, 0]


def test_compare_datasets(spark, rows):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y"), (3, None, "z"), (None, 4.0, "w")], "k int, v double, t string")
    b = spark.createDataFrame([(1, 1.0 + 1e-12, "x"), (2, 2.5, "q"), (4, 1.0, "n"), (None, 4.0, "w")], "k int, v double, t string")
    same = compare.compare_datasets(a, a, ["k"])
    assert same.differences.count() == same.only_in_base.count() == same.only_in_compare.count() == same.schema.count() == 0
    found = compare.compare_datasets(a, b, ["k"])
    assert rows(found.differences) == [(2, "t", "y", "q"), (2, "v", "2.0", "2.5")]
    assert rows(found.only_in_base) == [(3,)] and rows(found.only_in_compare) == [(4,)]
    assert rows(found.by_variable) == [("t", 1), ("v", 1)]
    status = compare.comparison_status(found.differences.select(F.lit("t1").alias("dataset")), ["t1", "t2"])
    assert rows(status) == [("t1", 2, "fail"), ("t2", 0, "pass")]


def test_compare_by_position(spark, rows):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "t string, v int")
    b = spark.createDataFrame([("x", 1), ("y", 9), ("z", 3)], "t string, v int")
    assert rows(compare.compare_datasets(a, b, order=["t"]).differences) == [(2, "v", "2", "9")]


def test_compare_schemas(spark, rows):
    a = spark.createDataFrame([(1, "x")], "i int, s string").select(F.col("i").alias("i", metadata={"displayFormat": "DATE9"}), "s")
    b = spark.createDataFrame([(1.0, "x", 1)], "i double, s string, n int")
    assert rows(compare.compare_schemas(a, b)) == [("i", "display_format", "DATE9", None), ("i", "type", "int", "double"), ("n", "column", None, "present")]


def test_text_status(spark, rows):
    a = spark.createDataFrame([("f", "one\ntwo\nstamp 1"), ("g", "one\ntwo")], "file string, text string")
    b = spark.createDataFrame([("f", "one\ntwo\nstamp 2"), ("g", "uno\ndos\nmore")], "file string, text string")
    la, lb = compare.text_lines(a, ["file"]), compare.text_lines(b, ["file"])
    assert rows(compare.text_status(la, lb, ["file"])) == [("f", 1, "pass"), ("g", 3, "fail")]
    assert rows(compare.text_differences(la, lb, ["file"]), "file", "line_no", "compare_line") == [("f", 3, "stamp 2"), ("g", 1, "uno"), ("g", 2, "dos"), ("g", 3, "more")]


def test_fenced_pairs(spark, rows):
    df = spark.createDataFrame([(1, "```csv\nVariable,Dataset\nAGE,adsl\nRACE,adsl\n```"), (2, "```\nAVAL,adadas\n```")], "k int, text string")
    assert rows(compare.parse_fenced_pairs(df, ["k"])) == [(1, "AGE", "adsl"), (1, "RACE", "adsl"), (2, "AVAL", "adadas")]


def test_restrict_columns(visits, rows):
    out = picks.restrict_columns(visits, {"n": F.col("seq") * 2}, F.col("v") > 1)
    assert rows(out, "seq", "n") == [(1, 2), (2, None), (3, None), (4, None), (5, 10)]


def test_baseline_record_equals_flag_then_lookup(spark, rows):
    df = spark.createDataFrame([(i % 4, i, i % 7, float(i % 5) if i % 6 else None) for i in range(60)], "id int, seq int, d int, AVAL double")
    early = F.col("d") < 3
    one = longitudinal.baseline_record(df, ["id"], ["d"], ["seq"], {"BASE": "AVAL"}, where=early)
    two = longitudinal.baseline(picks.flag_extreme(df, ["id"], ["d"], ["seq"], "ABLFL", "last", early), ["id"], "AVAL", "BASE")
    assert rows(one, "seq", "ABLFL", "BASE") == rows(two, "seq", "ABLFL", "BASE")


def test_closest_records_are_the_flagged_ones(spark, rows):
    df = ranges.visit_of_day(spark.createDataFrame([(i % 3, i, (i * 17) % 200) for i in range(80)], "id int, seq int, ADY int"), SCORE)
    flagged = longitudinal.flag_closest(df, ["id", "AVISIT"], ["seq"]).filter("ANL01FL = 'Y'")
    assert rows(longitudinal.closest_records(df, ["id", "AVISIT"], ["seq"]), "seq") == rows(flagged, "seq")


def test_population_join_keeps_everyone(spark, visits, rows):
    population = spark.createDataFrame([("a",), ("z",)], "id string")
    assert rows(merges.population_right_join(visits, population, ["id"]), "id", "seq") == [("a", 1), ("a", 2), ("a", 3), ("z", None)]


def test_merge_one_to_one_gives_the_same(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    add = spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("b", 3, None)], "id string, seq int, w int")
    args = (add, ["id"], {"new": "w"}, None, ["seq"], "last")
    assert rows(merges.merge_vars(df, *args)) == rows(merges.merge_vars(df, *args, one_to_one=True)) == [("a", 6), ("b", None), ("c", None)]


def test_natural_and_full_joins(spark, rows):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "k int, t string, v double")
    b = spark.createDataFrame([(1, "x", "p"), (2, "z", "q")], "k int, t string, m string")
    assert rows(merges.natural_join(a, b), "k", "t", "v", "m") == [(1, "x", 1.0, "p")]
    assert rows(merges.stamp_full_join(a, b, ["k", "t"]), "k", "t", "v", "m") == [(1, "x", 1.0, "p"), (2, "y", 2.0, None), (2, "z", None, "q")]


def test_codelist_table_and_literal_agree(spark, rows):
    df = spark.createDataFrame([("A",), ("B",), ("?",), (None,)], "s string")
    codes = spark.createDataFrame([(1, "A"), (2, "B")], "code int, decode string")
    want = [("?", None), ("A", 1), ("B", 2), (None, None)]
    assert rows(merges.map_codelist(df, codes, "s", "n"), "s", "n") == want
    assert rows(merges.map_codelist(df, {"A": 1, "B": 2}, "s", "n"), "s", "n") == want
    assert rows(compare.codelist_offenders(df, "s", codes, "decode")) == [("s", "?", 1)]


def test_conformance_counts(spark, rows):
    columns = spark.createDataFrame([("d1", "ADT", "date", "Date", None), ("d1", "AGE", "double", "Age (y)", None)], "dataset string, name string, type string, label string, display_format string")
    standard = spark.createDataFrame([("ADT", "Date", "date"), ("AGE", "Age", "int")], "name string, label string, type string")
    names = spark.createDataFrame([("d1", "Mine", "Standard")], "dataset string, label string, standard_label string")
    assert rows(compare.conformance(columns, standard, names)) == [("AD0018", "d1", 1), ("AD0041A", "d1", 1), ("AD0320", "d1", 1), ("SD0059", "d1", 1)]


# ------------------------------------------------------------- keys of different types
@pytest.mark.parametrize(
    ("left", "right"),
    [("int", "bigint"), ("decimal(10,2)", "decimal(12,4)"), ("date", "timestamp_ntz"), ("string", "string"), ("float", "double")],
)
def test_lookup_join_compares_in_the_common_type(spark, left, right):
    value = {"date": "DATE'2024-01-0{}'", "string": "'k{}'"}.get(left, "{}")
    rows = " UNION ALL ".join(f"SELECT CAST({value.format(i)} AS {{}}) AS k, {i} AS v" for i in (1, 2, 3))
    a = spark.sql(rows.replace("{}", left)).withColumnRenamed("v", "a")
    b = spark.sql(rows.replace("{}", right)).withColumnRenamed("v", "b").filter("b < 3")
    assert sorted(tuple(r) for r in joins.lookup_join(a, b, ["k"]).select("a", "b").collect()) == [(1, 1), (2, 2), (3, None)]
    found = merges.population_right_join(b, a.select("k"), ["k"])
    assert found.count() == 3 and found.filter("b IS NOT NULL").count() == 2


def test_null_keys_match_only_if_asked(spark):
    a, b = spark.createDataFrame([(None, 1), (1, 2)], "k int, a int"), spark.createDataFrame([(None, 7)], "k long, b int")
    assert [r.b for r in joins.lookup_join(a, b, ["k"]).orderBy("a").collect()] == [None, None]
    assert [r.b for r in joins.lookup_join(a, b, ["k"], null_safe=True).orderBy("a").collect()] == [7, None]


def test_repeated_codes_and_subjects_are_refused(spark):
    df = spark.createDataFrame([(1,)], "c int")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "code int, decode string")
    with pytest.raises(Exception, match="duplicate key in merge"):
        merges.map_codelist(df, twice, "c", "d", decode_to_code=False).collect()


def test_comparison_with_itself_and_with_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "k int, v string")
    assert compare.findings(df, df, ["k"]).count() == 0
    twice = df.union(df.limit(1))
    with pytest.raises(Exception, match="duplicate key in comparison"):
        compare.findings(twice, twice, ["k"]).collect()
    other = spark.createDataFrame([(1, "x"), (4, "b")], "k bigint, v string")
    got = sorted((r.k is None, r.k, r.side, r.variable) for r in compare.findings(df, other, ["k"]).collect())
    assert got == [(False, 1, "DIFF", "v"), (False, 3, "BASE", None), (False, 4, "COMPARE", None), (True, None, "BASE", None)]


def test_supplemental_keys_that_read_as_one_number(spark):
    parent = spark.createDataFrame([("s", 1), ("s", 2)], "u string, seq int")
    supp = spark.createDataFrame([("s", "1", "A", "x"), ("s", " 1", "A", "y"), ("s", "odd", "A", "z")], "u string, IDVARVAL string, QNAM string, QVAL string")
    with pytest.raises(Exception, match="duplicate key in merge"):
        merges.join_supp(parent, supp, ["u"], ["A"], "seq").collect()
    got = merges.join_supp(parent, supp.filter("IDVARVAL <> '1'"), ["u"], ["A"], "seq").collect()
    assert sorted((r.seq, r.A) for r in got) == [(1, "y"), (2, None)]


def test_arm_header_with_named_arms(spark):
    counts = spark.createDataFrame([("A", 3), ("C", 5), ("D", 7)], "arm string, n long")
    assert summary.arm_header(counts, "arm", "n", counts, names=["C", "B", "A"]).first()[0] == "|C\\line(N=5)|B\\line(N=0)|A\\line(N=3)"


def test_cell_digests_see_a_changed_cell(spark):
    df = spark.createDataFrame([(1, "a", 1.5, [1.0]), (2, None, None, None)], "i int, s string, d double, l array<float>")
    same = {r.variable: (r.n_filled, r.digest) for r in compare.cell_digests(df).collect()}
    changed = compare.cell_digests(df.withColumn("s", F.concat("s", F.lit("b"))).withColumn("d", F.col("d") + 0.01).repartition(3))
    other = {r.variable: (r.n_filled, r.digest) for r in changed.collect()}
    assert {k for k in same if same[k] != other[k]} == {"s", "d"} and same["l"][0] == 1
