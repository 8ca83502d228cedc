"""Interval lookup against a plain loop, for uneven, open, overlapping and typed intervals."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from subjectflow.operators import ranges


def _plain(values, intervals, ends):
    out = []
    for g, v in values:
        hits = [
            n for h, n, lo, hi in intervals
            if h == g and v is not None and (lo is None or (v >= lo if ends[0] == "[" else v > lo)) and (hi is None or (v <= hi if ends[1] == "]" else v < hi))
            and (lo is None or hi is None or lo <= hi)
        ]
        out += [(g, v, n) for n in hits or [None]]
    return sorted(out, key=str)


@pytest.mark.parametrize("ends", ["[]", "[)", "(]", "()"])
def test_overlapping_open_and_uneven(spark, ends):
    chance = random.Random(1)
    intervals = []
    for n in range(300):
        lo = chance.choice([chance.uniform(-50, 50), float(chance.randint(-5, 5)), 1e9 * chance.random(), 0.0])
        intervals.append((chance.choice("ab"), n, chance.choice([lo, lo, None]), chance.choice([lo + chance.choice([0, 1e-7, 0.5, 8, 1e6]), lo - 1, None])))
    values = [(chance.choice("abc"), chance.choice([chance.uniform(-60, 60), float(chance.randint(-6, 6)), None, 1e9 * chance.random(), chance.choice(intervals)[2]])) for _ in range(400)]
    values += values[:30]
    given = spark.createDataFrame(intervals, "g string, n int, lo double, hi double")
    found = ranges.interval_lookup(spark.createDataFrame(values, "g string, v double"), "v", given, "lo", "hi", ["n"], ["g"], ends, "list")
    assert sorted([tuple(r) for r in found.collect()], key=str) == _plain(values, intervals, ends)


def test_one_interval_or_an_error(spark):
    given = spark.createDataFrame([(0, 10, "a"), (10, 20, "b"), (None, -5, "c"), (30, None, "d")], "lo int, hi int, name string")
    df = spark.createDataFrame([(i, i) for i in (-9, -5, -4, 0, 9, 11, 20, 21, 30, 99, None)], "id int, v int").withColumn("name", F.lit("old"))
    got = {r.id: r.name for r in ranges.interval_lookup(df, "v", given, "lo", "hi", ["name"]).collect()}
    assert got == {-9: "c", -5: "c", -4: None, 0: "a", 9: "a", 11: "b", 20: "b", 21: None, 30: "d", 99: "d", None: None}
    with pytest.raises(Exception, match="overlap at v 10"):
        ranges.interval_lookup(spark.createDataFrame([(1, 10)], "id int, v int"), "v", given, "lo", "hi", ["name"]).collect()
    assert ranges.interval_lookup(df, "v", given.limit(0), "lo", "hi", ["name"]).filter("name is null").count() == 11
    with pytest.raises(ValueError, match="unknown ends"):
        ranges.interval_lookup(df, "v", given, "lo", "hi", ["name"], ends="<>")


def test_dates_and_large_numbers(spark):
    days = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2020, 1, 31), "jan"), (dt.date(2020, 2, 1), None, "later")], "lo date, hi date, name string")
    df = spark.createDataFrame([(dt.date(2019, 12, 31),), (dt.date(2020, 1, 31),), (dt.date(2024, 2, 29),)], "v date")
    assert [r.name for r in ranges.interval_lookup(df, "v", days, "lo", "hi", ["name"]).orderBy("v").collect()] == [None, "jan", "later"]
    big = 1 << 62
    exact = spark.createDataFrame([(big, big + 1, "x"), (big + 2, big + 3, "y")], "lo long, hi long, name string")
    longs = spark.createDataFrame([(big + i,) for i in range(-1, 5)], "v long")
    assert [r.name for r in ranges.interval_lookup(longs, "v", exact, "lo", "hi", ["name"]).orderBy("v").collect()] == [None, "x", "x", "y", "y", None]
    moments = spark.createDataFrame([(dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 12), "am")], "lo timestamp_ntz, hi timestamp_ntz, name string")
    at = spark.createDataFrame([(dt.datetime(2020, 1, 1, 11, 59),), (dt.datetime(2020, 1, 1, 12, 1),)], "v timestamp_ntz")
    assert [r.name for r in ranges.interval_lookup(at, "v", moments, "lo", "hi", ["name"]).orderBy("v").collect()] == ["am", None]


def test_no_nested_loop_and_few_candidates(spark):
    given = spark.range(10_000).select((F.col("id") * 2.0).alias("lo"), (F.col("id") * 2.0 + F.when(F.col("id") % 100 == 0, 1.9).otherwise(0.001)).alias("hi"), "id")
    df = spark.range(50_000).select((F.rand(3) * 20_000).alias("v"))
    found = ranges.interval_lookup(df, "v", given, "lo", "hi", ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    hit = found.filter("id is not null").agg(F.count("*"), F.count_if((F.col("v") < F.col("id") * 2) | (F.col("v") > F.col("id") * 2 + 1.9))).first()
    assert hit[0] > 300 and hit[1] == 0
