"""Exact top-k by inner product with a pivot table.

Distances of all vectors to some pivots are known beforehand. By the triangle inequality
``|d(q, p) - d(v, p)|`` is at most ``d(q, v)``, and the largest of these lower bounds over
the pivots turns into an upper bound of the inner product:
``(|q|^2 + |v|^2 - bound^2) / 2``. Candidates are taken in the order of this bound; when the
best bound left is below the k-th score found, the rest can't matter. A first pass over one
block gives each query a k-th score to start with, so that later blocks stop earlier.

Queries and candidates meet block by block, all pairs of blocks once. Vectors of different
lengths have no inner product and do not meet. Rows without an id, null vectors and vectors
that hold a null or a value that is not finite take no part; rows that repeat an id count
once, by their smallest vector. An empty table has an empty result. Components so large that
a score could exceed 64 bits are an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subjectflow.llm.common import stored
from subjectflow.llm.vectors import blocked, blocks_of, finite, matrix, met, one_per_id

K = 20
PIVOTS = 16
#: Candidates taken in bound order before the rest of a block, and queries handled together.
FIRST, TOGETHER = 256, 256


def scaled(rows: DataFrame, scale: int = 64, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``v`` (floor of scale times each component), ``dim`` of the usable rows."""
    usable = rows.filter(F.col(key).isNotNull() & finite(vector))
    v = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return usable.select(F.col(key).cast("long").alias("vec_id"), v.alias("v"), F.size(vector).alias("dim"))


def pivots(rows: DataFrame, count: int = PIVOTS) -> dict[int, np.ndarray]:
    """For each length some vectors far from one another, from a fixed small sample (farthest first)."""
    sample = rows.withColumn("h", F.xxhash64("vec_id", F.lit(5))).orderBy("h", "vec_id", "v").limit(count * 16).select("dim", "v").collect()
    out = {}
    for dim in {r["dim"] for r in sample}:
        v = np.array([r["v"] for r in sample if r["dim"] == dim], dtype=float).reshape(-1, dim)
        chosen, away = [0], _distances(v, v[:1])[:, 0]
        while len(chosen) < min(count, len(v)) and away.max() > 0:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, _distances(v, v[chosen[-1:]])[:, 0])
        out[dim] = v[chosen]
    return out


def _distances(v: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (v**2).sum(axis=1)[:, None] + (p**2).sum(axis=1)[None, :] - 2 * v @ p.T))


def best(q: np.ndarray, v: np.ndarray, q_ids: np.ndarray, v_ids: np.ndarray, p: np.ndarray, floor: np.ndarray, k: int = K) -> list[tuple]:
    """(query, candidate, score) of all candidates that may be among a query's k best.

    ``floor``: a score that a query's k-th best is known to reach. ``v_ids`` ascend.
    """
    out: list[tuple] = []
    largest = max(1, int(np.abs(q).max(initial=0)), int(np.abs(v).max(initial=0)))
    if q.shape[1] * largest**2 >= 1 << 63:
        raise OverflowError("inner products beyond 64 bits")
    exact = float if q.shape[1] * largest**2 < 1 << 52 else np.int64
    to_q, to_v = (_distances(x.astype(float), p) if len(p) else np.zeros((len(x), 0)) for x in (q, v))
    # both ends of a bound may be off by rounding: give way by more than that
    slack = 1e-5 * (1 + max(to_q.max(initial=0), to_v.max(initial=0)))
    vv, qq = (v.astype(float) ** 2).sum(axis=1), (q.astype(float) ** 2).sum(axis=1)
    to_v32, v_exact = to_v.T.astype(np.float32), v.astype(exact)
    for at in range(0, len(q), TOGETHER):
        rows = slice(at, at + TOGETHER)
        low = np.zeros((len(qq[rows]), len(v)), dtype=np.float32)
        for j in range(to_q.shape[1]):
            np.maximum(low, np.abs(to_q[rows, j].astype(np.float32)[:, None] - to_v32[j][None, :]), out=low)
        low = np.maximum(0, low.astype(float) - slack)
        bound = (qq[rows][:, None] + vv[None, :] - low**2) / 2 + 1e-9 * (qq[rows][:, None] + vv[None, :])
        bound[q_ids[rows][:, None] == v_ids[None, :]] = -np.inf
        some = min(FIRST, len(v))
        first = np.argpartition(-bound, some - 1, axis=1)[:, :some]
        open_rows = []
        for i in range(len(bound)):
            row, limit = at + i, floor[at + i]
            take = first[i][bound[i, first[i]] > -np.inf]
            scores = v_exact[take] @ q[row].astype(exact)
            if len(take) >= k:
                limit = max(limit, np.partition(scores, len(take) - k)[len(take) - k])
            rest = bound[i].copy()
            rest[first[i]] = -np.inf
            if rest.max(initial=-np.inf) >= limit and np.isfinite(rest.max(initial=-np.inf)):
                open_rows.append((i, limit))
            else:
                out += _top(q_ids[row], v_ids[take], scores, limit, k)
        if open_rows:  # the bounds didn't stop here: what is left of the block, together
            left = [i for i, _ in open_rows]
            scores = q[rows][left].astype(exact) @ v_exact.T
            for (i, limit), row_scores in zip(open_rows, scores, strict=True):
                take = np.flatnonzero(bound[i] >= limit) if np.isfinite(limit) else np.flatnonzero(bound[i] > -np.inf)
                out += _top(q_ids[at + i], v_ids[take], row_scores[take], limit, k)
    return out


def _top(query: int, ids: np.ndarray, scores: np.ndarray, limit: float, k: int) -> list[tuple]:
    some = np.flatnonzero(scores >= limit) if np.isfinite(limit) else np.arange(len(ids))
    some = some[np.lexsort((ids[some], -scores[some]))][:k]
    return [(int(query), int(ids[i]), int(scores[i])) for i in some]


def search(rows: DataFrame, is_query, k: int = K, scale: int = 64) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's k best among all other rows."""
    ints = stored(scaled(rows, scale), "topk-ints")
    table = pivots(ints)
    queries = ints.filter(is_query(F.col("vec_id")))
    n, m = ints.count(), queries.count()
    blocks, query_blocks = blocks_of(n), blocks_of(m)
    ints, queries = blocked(ints, "vec_id", blocks), blocked(queries, "vec_id", query_blocks)
    schema = "query_id long, vec_id long, score long"

    def compare(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(there):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        asked, there = one_per_id(asked, "vec_id"), one_per_id(there, "vec_id")
        floor = asked["floor"].fillna(-np.inf).to_numpy(dtype=float)
        found = best(matrix(asked["v"], "int64"), matrix(there["v"], "int64"), asked["vec_id"].to_numpy(), there["vec_id"].to_numpy(),
                     table.get(int(asked["dim"].iat[0]), np.zeros((0, 1))), floor, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    start = met(queries.withColumn("floor", F.lit(None).cast("double")), ints.filter("block = 0"), 1, query_blocks, compare, schema)
    nth = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = start.withColumn("rank", F.row_number().over(nth)).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
    queries = queries.join(floors, "vec_id", "left")
    found = met(queries, ints, blocks, query_blocks, compare, schema)
    return found.withColumn("rank", F.row_number().over(nth)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


#: The same search in DuckDB's SQL.
ORACLE_SQL = """
WITH u AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)) AS v FROM u),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20
"""
