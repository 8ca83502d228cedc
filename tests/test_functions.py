"""Column functions on hand-made cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from subjectflow.functions import cells, dates, formats, stats


def values(spark, column, data, schema):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.coalesce(1).select(column).collect()]


def test_null_rules(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, t boolean").coalesce(1)
    got = df.select(
        cells.if_else(F.col("t"), F.lit("a"), F.lit("b")), cells.case_chain([(F.col("t"), F.lit("a"))], F.lit("b")), cells.flag(F.col("t"))
    ).collect()
    assert [tuple(r) for r in got] == [("a", "a", "Y"), ("b", "b", None), (None, "b", None)]


def test_sum_rules(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("c", 2.0), ("c", 3.0)], "g string, v double")
    got = {r.g: (r.p, r.z, r.n, r.m) for r in df.groupBy("g").agg(
        cells.sum_or_null("v").alias("p"), cells.sum_or_zero("v").alias("z"), cells.n_distinct("v").alias("n"), cells.mean_or_null("v").alias("m")
    ).collect()}
    assert got == {"a": (None, 1.0, 2, None), "b": (None, 0.0, 1, None), "c": (5.0, 5.0, 2, 2.5)}


def test_blank_rules_keep_metadata(spark):
    df = spark.createDataFrame([("", 1), ("x", 2), (None, 3)], "s string, i int")
    df = df.select(F.col("s").alias("s", metadata={"label": "Text"}), "i")
    nulls = cells.blanks_to_null(df)
    assert [r.s for r in nulls.orderBy("i").collect()] == [None, "x", None]
    assert [r.s for r in cells.nulls_to_blank(nulls).orderBy("i").collect()] == ["", "x", ""]
    assert cells.nulls_to_blank(nulls).schema["s"].metadata == {"label": "Text"}


def test_membership_never_null(spark):
    assert values(spark, ~cells.is_in("s", ["a"]), [("a",), ("b",), (None,)], "s string") == [False, True, True]


def test_numbers_from_text(spark):
    data = [("NA",), ("",), ("  1.0",), ("WEEK 24",), ("-7",)]
    assert values(spark, cells.to_number("s"), data, "s string") == [None, None, 1.0, None, -7.0]
    assert values(spark, cells.digits_to_number("s"), data, "s string") == [None, None, 10.0, 24.0, 7.0]


def test_text_cases(spark):
    assert values(spark, cells.sentence_case("s"), [("SCREENING 1",), (None,)], "s string") == ["Screening 1", None]
    got = values(spark, cells.title_case("s"), [("ADAS-COG(11) Subscore",), ("word recall task",), ("DON'T stop",), (None,)], "s string")
    assert got == ["Adas-Cog(11) Subscore", "Word Recall Task", "Don't Stop", None]


def test_pads_keep_long_text(spark):
    assert values(spark, cells.pad_left("s", 3, "0"), [("7",), ("1234",)], "s string") == ["007", "1234"]
    assert values(spark, cells.pad_right("s", 3), [("7",), ("1234",)], "s string") == ["7  ", "1234"]
    assert values(spark, cells.paste("s", F.lit("-")), [("a",), (None,)], "s string") == ["a-", "NA-"]


def test_rounding_ties(spark):
    data = [(2.5,), (-2.5,), (0.5,), (None,)]
    assert values(spark, cells.round_half_up("x"), data, "x double") == [3.0, -3.0, 1.0, None]
    assert values(spark, cells.round_half_even("x"), data, "x double") == [2.0, -2.0, 0.0, None]
    assert values(spark, cells.round_half_up("x", 1), [(0.15,), (1.25,)], "x double") == [0.2, 1.3]
    # 0.15 is stored slightly below, 0.35 slightly below, 2.675 below, 0.25 exactly.
    assert values(spark, cells.round_half_even("x", 1), [(0.15,), (0.35,), (0.25,)], "x double") == [0.1, 0.3, 0.2]
    assert values(spark, cells.round_half_even("x", 2), [(2.675,)], "x double") == [2.67]


def test_fixed_text_equals_exact_binary_rounding(spark):
    rnd = random.Random(5)
    xs = [(rnd.choice([rnd.uniform(-1e4, 1e4), rnd.randint(-5000, 5000) / 1000, rnd.randint(-400, 400) / 8]),) for _ in range(3000)]
    for digits in (0, 1, 2, 3):
        got = values(spark, formats.fixed("x", digits), xs, "x double")
        want = [f"{x:.{digits}f}" for (x,) in xs]
        assert [(g, w) for g, w in zip(got, want) if g != w] == []
    assert values(spark, formats.num_fmt("x", 1, 4, 2), [(-0.04,)], "x double") == [" 0.0"]


def test_report_formats(spark):
    df = spark.createDataFrame([(5.4, 1.34, 0.16, -0.31, 0.63, 0.245, 21.0, 5.0, 61.0)], "m double, s double, e double, l double, u double, p double, d double, lo double, hi double")
    got = df.select(
        formats.fmt_est("m", "s"), formats.fmt_ci("e", "l", "u"), formats.num_fmt("p", 3, 12, 4), formats.masked("xx.x (xxx;xx)", "d", "lo", "hi"),
        formats.fmt_pval("p"), formats.fmt_pval(F.lit(0.0002)), formats.num_fmt(F.lit(None).cast("double")),
        formats.masked("xx.xx (xx.xx)", "d", F.lit(None).cast("double"), align=False), formats.fmt_num("m", 1),
    ).first()
    assert tuple(got) == ("  5.4 ( 1.34)", " 0.16 (-0.31, 0.63)", "   0.245    ", "21.0 (  5;61)", "  0.245", "<0.001", "", "", "  5.4")


@pytest.mark.parametrize(
    "text,level,how,cap,want",
    [
        ("2013-07-15", "n", "first", None, "2013-07-15"),
        ("2013-07-15T10:30", "n", "first", None, "2013-07-15"),
        ("2013-07", "n", "first", None, None),
        ("2013-07", "D", "first", None, "2013-07-01"),
        ("2013-07", "D", "last", None, "2013-07-31"),
        ("2013-07", "D", "mid", None, "2013-07-15"),
        ("2013", "D", "first", None, None),
        ("2013", "M", "first", None, "2013-01-01"),
        ("2013", "M", "last", "2013-03-04", "2013-03-04"),
        ("2013---15", "M", "first", None, "2013-01-01"),
        ("2013", "M", "last", "2012-03-04", "2013-12-31"),
        ("2013-02", "M", "last", None, "2013-02-28"),
        (None, "Y", "last", "2013-03-04", "2013-03-04"),
        ("", "Y", "last", "2013-03-04", "2013-03-04"),
        ("", "M", "last", "2013-03-04", None),
        ("2013-02-31", "D", "first", None, None),
        ("2014-01-05", "Y", "last", "2013-03-04", "2014-01-05"),
        ("UNKNOWN", "M", "first", None, None),
    ],
)
def test_impute_date(spark, text, level, how, cap, want):
    df = spark.createDataFrame([(text, cap)], "s string, c string").withColumn("c", F.col("c").cast("date"))
    got = df.select(dates.impute_date("s", level, how, max_dates=["c"])).first()[0]
    assert got == (dt.date.fromisoformat(want) if want else None)


def test_impute_datetime(spark):
    data = [("2013-07",), ("2013-07-04",), ("2013-07-04T10:30",), ("2013-07-04T10:30:05",), ("2013",), (None,)]
    got = values(spark, dates.impute_datetime("s", "D"), data, "s string")
    assert got == [dt.datetime(2013, 7, 1), dt.datetime(2013, 7, 4), dt.datetime(2013, 7, 4, 10, 30), dt.datetime(2013, 7, 4, 10, 30, 5), None, None]
    assert values(spark, dates.impute_datetime("s", "h", "last"), data[:2], "s string") == [None, dt.datetime(2013, 7, 4, 23, 59, 59)]
    assert values(spark, dates.impute_datetime("s", "n"), data[1:4], "s string") == [None, None, dt.datetime(2013, 7, 4, 10, 30, 5)]


def test_study_day_has_no_zero(spark):
    df = spark.createDataFrame([("2013-07-04", "2013-07-05"), ("2013-07-05", "2013-07-05"), ("2013-07-06", "2013-07-05"), (None, "2013-07-05")], "d string, r string").coalesce(1)
    assert [r[0] for r in df.select(dates.study_day("d", "r")).collect()] == [-1, 1, 2, None]


def test_durations(spark):
    df = spark.createDataFrame([("2013-07-01", "2013-10-04"), ("2013-05-05", "2013-05-07"), ("2013-05-05", None)], "s string, e string").coalesce(1)
    got = df.withColumn("n", dates.duration("s", "e")).select("n", dates.duration_unit("n", "DAYS"), dates.duration("s", "e", "months")).collect()
    assert [tuple(r)[:2] for r in got] == [(96, "DAYS"), (3, "DAYS"), (None, None)]
    assert abs(got[0][2] - 96 / 30.4375) < 1e-12


def test_t_distribution():
    assert abs(stats.t_two_sided(2.228138851964939, 10) - 0.05) < 1e-10
    assert abs(stats.t_two_sided(12.706204736432095, 1) - 0.05) < 1e-10
    assert abs(stats.t_quantile(0.95, 4) - 2.7764451051977987) < 1e-9
    assert abs(stats.t_two_sided(1.0, 5e6) - stats.t_two_sided(1.0, 5e7)) < 1e-6
    assert abs(stats.t_two_sided(0.3, 93) - 0.7648) < 1e-3


def test_clean_precision(spark):
    data = [(3.5,), (1.25,), (4.100000001,), (12.0,), (0.0,), (None,)]
    assert values(spark, cells.clean_precision("x"), data, "x double") == [3.5, 1.25, 4.1, 12.0, 0.0, None]


def test_round_half_up_of_values_without_a_fraction(spark):
    import math

    from pyspark.sql import functions as F

    from subjectflow.functions.cells import round_half_up

    values = [1e19, -1e19, 9.3e16, float("inf"), float("-inf"), 2.5, -2.5, 0.125]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", round_half_up("x", 2).alias("r"))
    assert [r.r for r in df.collect()] == [1e19, -1e19, 9.3e16, math.inf, -math.inf, 2.5, -2.5, 0.13]
    assert spark.range(1).select(round_half_up(F.lit(float("nan")), 1).alias("r")).first().r != 0


def test_t_law_at_its_ends():
    import math

    from subjectflow.functions.stats import t_quantile, t_two_sided

    assert abs(t_quantile(0.99999, 1) - math.tan(math.pi * 0.99999 / 2)) < 1e-2
    below, above = t_two_sided(2.1, 1e7), t_two_sided(2.1, 1e7 * (1 + 1e-9))
    assert abs(below - above) < 1e-9 and t_two_sided(math.inf, 5) == 0.0
