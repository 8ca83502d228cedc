"""A subject that owns a third of all rows: results stay right and the join splits."""

import pytest
from pyspark.sql import functions as F

from subjectflow.operators import longitudinal, merges, picks, summary

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB",
    "spark.sql.shuffle.partitions": "16",
}
ROWS = 300_000


@pytest.fixture
def hot(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    rows = spark.range(0, ROWS, 1, 16)
    yield rows.select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000 + 10).alias("subject"),
        F.col("id").alias("seq"),
        F.hash("id").cast("double").alias("value"),
        F.when(F.col("id") < 20_000, F.lit("Y")).alias("first_rows"),
    )
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_baseline_join_splits_the_hot_subject(hot):
    base = picks.flag_extreme(hot, ["subject"], ["value"], ["seq"], "ABLFL")
    # Two frames are needed: the flag's own join and the one under test.
    out = longitudinal.baseline(base, ["subject"], "value", "BASE")
    total = out.agg(F.count("*").alias("n"), F.count("BASE").alias("b"), F.count_if(F.col("value") < F.col("BASE")).alias("bad"))
    assert "skew=true" in final_plan(total)
    assert tuple(total.first()) == (ROWS, ROWS, 0)


def test_group_max_and_merge_split_too(hot):
    flagged = picks.flag_group_max(hot, ["subject"], "seq", "fl").groupBy("fl").count()
    assert "skew=true" in final_plan(flagged)
    assert dict(tuple(r) for r in flagged.collect())["Y"] == hot.select("subject").distinct().count()
    merged = merges.merge_vars(hot, hot, ["subject"], {"top": "value"}, order=["value", "seq"])
    merged = merged.agg(F.count("top").alias("n"), F.sum("seq"), F.max("value"))
    assert "skew=true" in final_plan(merged) and merged.first()["n"] == ROWS


def test_picking_sends_few_rows_of_the_hot_subject(hot):
    picked = picks.pick_row(hot, ["subject"], ["-value", "seq"])
    assert "WindowGroupLimit" in final_plan(picked)
    want = hot.groupBy("subject").agg(F.max("value").alias("m"))
    assert picked.join(want, "subject").filter("value <> m").count() == 0


def test_population_join_and_median(spark, hot):
    population = spark.createDataFrame([(7,), (10,), (-1,)], "subject long")
    joined = merges.population_right_join(hot, population, ["subject"]).groupBy("subject").agg(F.count("seq").alias("n"))
    counts = dict(tuple(r) for r in joined.collect())
    assert counts[7] == ROWS // 3 and counts[-1] == 0
    one = hot.withColumn("g", F.lit("all"))
    got = summary.exact_median(one, ["g"]).first()["median"]
    assert got == hot.agg(F.percentile("value", 0.5)).first()[0]
