"""Source mix against iterative water-filling and its own SQL."""

from collections import Counter

import duckdb
import pytest

from subjectflow.llm import mixing
from subjectflow.llm.common import table

from .conftest import CLASHING


def filled(sizes):
    """Targets by clamping and sharing again until nothing is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    cap = {s: 3 * sizes[s] for s in order}
    left, free, target = sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap[s]}
        for s in over or free:
            target[s] = cap[s] if over else level * weight[s]
        left -= sum(cap[s] for s in over)
        free -= over or free
    return target


def test_targets_and_taken_words(spark, docs):
    draw = [(i, "w " * (1 + i * 7 % 90), "abc"[i % 7 % 3]) for i in range(900)] + [(5000, "one two", "tiny"), (5001, None, None), (5002, "a b c", None), (5003, "", "void")]
    got = mixing.mix(docs(draw, CLASHING)).collect()
    source = {i: s for i, _, s in draw}
    sizes = {}
    for r in got:
        sizes[source[r.doc_id]] = r.source_size
    want = filled(sizes)
    taken = dict.fromkeys(want, 0)
    for r in got:
        assert r.target == pytest.approx(want[source[r.doc_id]]) and r.taken == r.times * r.size <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= max(6, 0.01 * want[s]) for s in want)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs(draw[::-1])).collect()))


def _by_row(df, sampled):
    """(id, words) by how often the mix and the sample take them."""
    taken, had = Counter(), Counter()
    for r in mixing.mix(df).collect():
        taken[r.doc_id, r.size] += r.times
    for r in sampled.collect():
        had[r.doc_id, len((r.text or "").split())] += 1
    return {k: n for k, n in taken.items() if n}, dict(had)


def test_sample_has_each_row_as_often_as_taken(spark, docs):
    rows = [(i, "w " * (i % 11), f"s{i % 4}") for i in range(400)] + [(None, "a b", "s1"), (7, "w w w", "s2")]
    df = docs(rows, CLASHING)
    sampled = mixing.sample(df)
    assert sampled.columns == df.columns
    taken, had = _by_row(df, sampled)
    assert taken == had
    assert mixing.sample(docs([])).count() == mixing.mix(docs([])).count() == 0


@pytest.mark.parametrize("copies", [1, 40])
def test_many_null_and_repeated_ids(spark, docs, copies):
    """A third of the rows under null, a third under one id, a source whose ids are all null; texts that repeat."""
    rows = [((None, 5, i)[i % 3], f"x{i // copies} " + "w " * (i % 50), f"s{i % 4}") for i in range(1200)]
    rows += [(None, f"y{i // copies} " + "w " * (i % 40), None) for i in range(500)]
    df = docs(rows, CLASHING).repartition(5)
    sampled = mixing.sample(df).cache()
    taken, had = _by_row(df, sampled)
    assert taken == had
    targets = {r.source: r.target for r in mixing.targets(mixing.sizes(df)).collect()}
    words = Counter()
    for r in sampled.collect():
        words[r.source] += len(r.text.split())
    assert all(abs(words[s] - t) <= 51 for s, t in targets.items())
    assert sorted(map(str, mixing.sample(df.repartition(3)).select("doc_id", "text").collect())) == sorted(map(str, sampled.select("doc_id", "text").collect()))


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "times", "taken").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(mixing.ORACLE_SQL).fetchall())
