"""Exact and approximate vector search against brute force."""

import numpy as np
import pandas as pd
import pytest

from subjectflow.llm import ann, topk
from subjectflow.llm.common import table


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def odd(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=8).tolist(), 0) for i in range(300)]
    rows += [(i, [1.0] * 8, 0) for i in range(300, 420)]  # many equal ones
    rows += [(500, None, 0), (501, [0.0] * 8, 0), (502, [1.0, None] * 4, 0), (503, [float("nan")] * 8, 0), (504, [float("inf")] * 8, 0)]
    rows += [(None, [1.0] * 8, 0), (520, [1.0, 2.0], 0), (521, [2.0, 1.0], 0), (3, rows[3][1], 0)]
    return vectors(spark, rows)


def test_topk_by_brute_force(spark):
    df = odd(spark)
    got = [tuple(r) for r in topk.search(df, lambda i: i % 20 == 0).select("query_id", "rank", "vec_id", "score").collect()]
    rows = {r.vec_id: np.floor(64 * np.array(r.embedding, dtype=float)).astype(int) for r in df.collect() if r.vec_id is not None and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()}
    want = []
    for q in [i for i in rows if i % 20 == 0]:
        scored = sorted((-int(rows[q] @ v), i) for i, v in rows.items() if i != q and len(v) == len(rows[q]))[:20]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    assert sorted(got) == sorted(want)
    assert topk.search(vectors(spark, []), lambda i: i % 20 == 0).count() == 0


def test_topk_large_components_stay_exact():
    q = np.array([[2**30, 3]])
    v = np.array([[2**30, 1], [2**30, 2], [-(2**30), 5]])
    some = (np.array([9]), np.array([1, 2, 3]), v[:1].astype(float), np.array([-np.inf]), 2)
    assert topk.best(q, v, *some) == [(9, 2, 2**60 + 6), (9, 1, 2**60 + 3)]
    with pytest.raises(OverflowError):
        topk.best(q * 8, v * 8, *some)


def test_topk_stops_early_on_separated_data():
    draw = np.random.default_rng(2)
    v = np.concatenate([draw.normal(0, 1, (400, 16)), draw.normal(0, 1, (400, 16)) + 50]).round().astype(int)
    found = topk.best(v[:3], v, np.arange(3), np.arange(800), v[[0, 799]].astype(float), np.full(3, -np.inf), 5)
    for i in range(3):
        want = sorted((-int(v[i] @ v[j]), j) for j in range(800) if j != i)[:5]
        assert sorted((-s, c) for q, c, s in found if q == i)[:5] == want


def test_hilbert_is_a_walk_through_all_cells():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    place = ann.hilbert(cells, 3)
    assert sorted(place) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def recall(spark, df, got):
    own = ann.usable(df).toPandas().drop_duplicates("vec_id")
    hits = total = 0
    for _, part in own.groupby("dim"):
        v, ids = np.array(part["v"].tolist(), dtype=float), part["vec_id"].to_numpy()
        asked = ids % 50 == 0
        if asked.any():
            true = ann.nearest(v[asked], v, ids[asked], ids, 5)
            total += len(true)
            hits += len(pd.merge(true, got, on=["query_id", "vec_id"]))
    return hits / total


def test_ann_recall_and_exact_scores(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    got = ann.search(df, lambda i: i % 50 == 0).toPandas()
    assert recall(spark, df, got) >= 0.9
    v = {r.vec_id: np.array(r.embedding, dtype=float) for r in df.collect()}
    for r in got.itertuples():
        a, b = v[r.query_id], v[r.vec_id]
        assert r.query_id != r.vec_id and abs(r.score - a @ b / np.sqrt(a @ a * (b @ b))) < 1e-12
    for _, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        assert list(part["rank"]) == list(range(1, len(part) + 1)) and part["score"].is_monotonic_decreasing


def test_ann_odd_rows(spark):
    got = ann.search(odd(spark), lambda i: i % 50 == 0).toPandas()
    assert set(got["query_id"]) == {0, 50, 100, 150, 200, 250, 300, 350, 400}
    assert got.groupby("query_id").size().eq(5).all()
    assert not set(got["vec_id"]) & {500, 501, 502, 503, 504}
    assert ann.search(vectors(spark, []), lambda i: i % 50 == 0).count() == 0
