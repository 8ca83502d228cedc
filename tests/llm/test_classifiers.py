"""Quality and toxicity: held-out accuracy, plain versions of their parts, odd inputs."""

import numpy as np

from subjectflow.llm import quality, toxicity
from subjectflow.llm.common import held_out, table, text_of
from subjectflow.llm.queries import QUERIES

from .conftest import CLASHING

SF = "/root/testdata/sf0.1"


def walked(model, x):
    """One row and one tree at a time."""
    out = []
    for row in x:
        total = model.base
        for t in range(len(model.feature)):
            at = 0
            while at < model.feature.shape[1]:
                at = 2 * at + 1 + int(row[model.feature[t, at]] > model.limit[t, at])
            total += model.value[t, at - model.feature.shape[1]]
        out.append(total)
    return np.array(out)


def test_flattened_trees_equal_a_plain_walk():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y, trees=20)
    assert np.allclose(model.margin(x), walked(model, x))
    assert ((model.score(x) > 0.5) == y).mean() > 0.97


def test_fit_without_labels_or_with_one_kind():
    none = quality.fit(np.zeros((0, 0)), np.zeros(0))
    assert np.allclose(none.score(np.zeros((2, len(quality.NAMES)))), 0.5)
    ones = quality.fit(np.ones((9, 3)), np.ones(9))
    assert np.allclose(ones.score(np.zeros((1, 3))), 10 / 11)


def measured(spark, name, label, threshold):
    got = QUERIES[name](spark, SF).join(table(spark, SF, "labels").select("doc_id", label), "doc_id").filter("held_out").toPandas()
    assert ((got["score"] >= threshold) == got["predicted"]).all() and got["score"].between(0, 1).all()
    return got


def test_quality_held_out(spark):
    got = measured(spark, "op10_quality_classifier", "quality", 0.3)
    good = got[got["quality"] == 1]
    assert (got["predicted"] == got["quality"]).mean() > 0.97 and good["predicted"].mean() > 0.98


def test_toxicity_held_out(spark):
    got = measured(spark, "op6_toxicity", "toxic", 0.5)
    toxic, clean = got[got["toxic"] == 1], got[got["toxic"] == 0]
    assert toxic["predicted"].mean() > 0.9 and clean["predicted"].mean() < 0.01


def test_scores_do_not_depend_on_other_columns(spark, docs):
    labels = table(spark, SF, "labels")
    rows = [(1, "One plain sentence of words."), (2, None), (3, ""), (4, "You idiot!"), (4, "You idiot!"), (None, "w " * 50_000)]
    a, b = docs(rows), docs([(99, *r[1:], "other") for r in rows], CLASHING)
    learned = table(spark, SF, "documents").limit(3000)
    model, judge = quality.train(learned, labels), toxicity.train(learned, labels)
    for score in (lambda d: quality.score_of(text_of(), model), lambda d: toxicity.score_of(text_of(), judge)):
        one, two = ([r[0] for r in d.select(score(d)).collect()] for d in (a, b))
        assert one == two and all(0 <= s <= 1 for s in one) and one[1] == one[2]


def test_keep_returns_the_same_columns(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    df = docs([(1, "Fine words here."), (2, None), (None, ""), (3, "a clown, a moron and an idiot")], CLASHING)
    assert quality.keep(df, labels).columns == df.columns and quality.keep(df, labels).count() == 4
    kept = toxicity.keep(df, labels)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "None"]
    assert quality.keep(docs([]), labels).count() == toxicity.keep(docs([]), labels).count() == 0


def test_label_model_finds_accuracies_and_repeated_voters():
    draw = np.random.default_rng(3)
    y = draw.random(4000) < 0.15
    fires = lambda hit, false: np.where(y, draw.random(4000) < hit, draw.random(4000) < false)
    a, b, c = fires(0.8, 0.02), fires(0.6, 0.01), fires(0.7, 0.05)
    votes = np.stack([a, a ^ (draw.random(4000) < 0.01), b, c], axis=1).astype(float)
    model = toxicity.LabelModel(0.15).fit(votes, np.where(votes.sum(axis=1) > 0, 0.9, 0.02))
    assert model.parent[1] == 0  # the copy hangs on what it repeats
    assert abs(model.fires[1, 0, 0] - 0.8) < 0.08 and model.fires[0, 0, 0] < 0.05
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95


def test_lexicon_boundaries_and_masked_spelling():
    voters = toxicity.voters_of(["=clod", "1^vex", "2^gru"])
    at = dict(voters.lexicon)
    count = voters.counts
    assert count("a clod.")[at["=clod"]] == 1 and count("clods")[at["=clod"]] == 0
    assert count("vexing")[at["1^vex"]] == 1 and count("convex")[at["1^vex"]] == 0
    assert count("gruff grunt")[at["2^gru"]] == 2 and count("gruff")[at["2^gru"]] == 0
    assert count("you 1d10t")[voters.lexicons] == 1 and sum(count("")) == 0


def test_held_out_rule(spark):
    import zlib

    got = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
