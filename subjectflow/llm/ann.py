"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are scaled to length one and projected to a few dimensions, several times: each
time with other random directions and another shift of the grid. The cells' places on a
Hilbert curve give an ordering per projection, which Spark range-partitions and sorts; a
row's rank in it is its place in its task plus the rows of the tasks before. A query meets
the rows within a window of ranks around its own on every curve; the finds of all curves
are merged and ranked by the exact cosine on the original vectors.

**The window is measured, not guessed.** For a bounded sample of queries (``MEASURED``) the
true neighbours are found by comparing with all rows, and the window is the one within
which, on the best of the curves, the share ``AIM`` of these neighbours lies. Where the data
have near neighbours, that is a few ranks. Where they have none to speak of (independent
directions in many dimensions), no ordering keeps them together and the window becomes a
share of the table: the search then costs as much as comparing with all rows, and still
finds what it should.

Rows without an id, null vectors, vectors of length zero or holding a null or a value that
is not finite take no part; vectors of different lengths do not meet; rows that repeat an
id count once, by their smallest vector. An empty table has an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subjectflow.llm.common import stored
from subjectflow.llm.vectors import finite, matrix, one_per_id

K = 5
CURVES = 4
DIMENSIONS, BITS = 6, 10
#: Queries whose true neighbours are found to measure the window, and the share that it must hold.
MEASURED, AIM = 200, 0.97
SEED = 20
#: Rows of a block of ranks, and queries that meet it at once.
ROWS_TOGETHER, QUERIES_TOGETHER = 2048, 2048


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer cells (rows by dimensions), by undoing the curve's
    reflections and exchanges bit by bit and reading the Gray code across dimensions."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        below = bit - 1
        for i in range(n):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(high, x[0] ^ below, x[0] ^ swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], dtype=np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        flip = np.where(x[n - 1] & bit, flip ^ (bit - 1), flip)
        bit >>= 1
    x ^= flip
    place = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << 1 | (x[i] >> b & 1)
    return place


def places(v: np.ndarray) -> np.ndarray:
    """Curve places (rows by curves) of vectors of one length."""
    unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
    out = np.zeros((len(v), CURVES), dtype=np.int64)
    for c in range(CURVES):
        draw = np.random.default_rng(SEED + c)
        directions = draw.standard_normal((v.shape[1], min(DIMENSIONS, v.shape[1])))
        shift = draw.random(directions.shape[1])
        cells = (unit @ directions / 8 + 0.5 + shift / 8) * (1 << BITS)
        out[:, c] = hilbert(np.clip(cells, 0, (1 << BITS) - 1).astype(np.int64), BITS)
    return out


def cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosine of pairs of rows, each from its two vectors alone (equal pairs give equal values)."""
    return (q * v).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((v * v).sum(axis=1)))


def nearest(q: np.ndarray, v: np.ndarray, q_ids: np.ndarray, v_ids: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's ``k`` nearest of a block, ties to the smaller id; both without zero vectors."""
    rough = (q / np.sqrt((q * q).sum(axis=1))[:, None]) @ (v / np.sqrt((v * v).sum(axis=1))[:, None]).T
    rough[q_ids[:, None] == v_ids[None, :]] = -np.inf
    kth = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(q), -2.0)
    row, col = np.nonzero((rough >= np.maximum(kth, -2.0)[:, None] - 1e-9))
    found = pd.DataFrame({"query_id": q_ids[row], "vec_id": v_ids[col], "score": cosines(q[row], v[col])})
    found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return found.groupby("query_id").head(k)


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``v``, ``dim`` of the rows that take part."""
    some = F.exists(F.col(vector), lambda x: x.cast("double") != 0)
    rows = rows.filter(F.col(key).isNotNull() & finite(vector) & some)
    return rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.size(vector).alias("dim"))


def ranked(rows: DataFrame) -> DataFrame:
    """``dim``, ``curve``, ``rank``, ``vec_id`` of every row on every curve (written to the shared folder)."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                at = places(matrix(part["v"], "float64"))
                for c in range(CURVES):
                    yield pd.DataFrame({"dim": dim, "curve": c, "place": at[:, c], "vec_id": part["vec_id"]})

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            batch["part"], batch["at"] = part, np.arange(n, n + len(batch))
            n += len(batch)
            yield batch[["dim", "curve", "vec_id", "part", "at"]]

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.mapInPandas(place, "dim int, curve int, place long, vec_id long")
    # the hash spreads rows of one cell, however many they are
    order = ["dim", "curve", "place", F.xxhash64("vec_id"), "vec_id"]
    sorted_ = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    local = stored(sorted_.mapInPandas(number, "dim int, curve int, vec_id long, part int, at long"), "ann-places")
    counts = local.groupBy("dim", "curve", "part").agg(F.count("*").alias("n"))  # one row per task and curve
    before = Window.partitionBy("dim", "curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("dim", "curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    joined = local.join(counts, ["dim", "curve", "part"])
    return stored(joined.select("dim", "curve", "vec_id", (F.col("before") + F.col("at")).alias("rank")), "ann-ranks")


def window(rows: DataFrame, queries: DataFrame, ranks: DataFrame, k: int) -> int:
    """Ranks to either side that hold the share ``AIM`` of the true neighbours of the measured queries."""
    sample = [tuple(r) for r in queries.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(MEASURED).select("dim", "vec_id", "v").collect()]
    if not sample:
        return 1
    asked = {d: [(i, list(v)) for dim, i, v in sample if dim == d] for d in {s[0] for s in sample}}

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                if dim in asked:
                    q = np.array([v for _, v in asked[dim]], dtype=float)
                    yield nearest(q, matrix(part["v"], "float64"), np.array([i for i, _ in asked[dim]]), part["vec_id"].to_numpy(), k)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = rows.mapInPandas(compare, "query_id long, vec_id long, score double").distinct().withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k)
    true = true.select("query_id", "vec_id")
    # at most MEASURED * k pairs
    theirs = ranks.join(F.broadcast(true), "vec_id").select("query_id", "vec_id", "curve", F.col("rank").alias("theirs"))
    own = ranks.join(F.broadcast(true.select(F.col("query_id").alias("vec_id")).distinct()), "vec_id").select(F.col("vec_id").alias("query_id"), "curve", "rank")
    apart = theirs.join(own, ["query_id", "curve"]).groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("theirs") - F.col("rank"))).alias("apart"))
    width = apart.agg(F.percentile("apart", F.lit(AIM)).alias("w")).first()["w"]
    return max(64, int(np.ceil(width or 0)))


def search(rows: DataFrame, is_query, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's ``k`` nearest found, by cosine."""
    own = stored(usable(rows), "ann-rows")
    ranks = ranked(own)
    asked = own.filter(is_query(F.col("vec_id")))
    width = window(own, asked, ranks, k)
    n, m = own.count(), asked.count()
    # queries that meet one block of ranks, in portions of about QUERIES_TOGETHER
    portions = max(1, -(-int(m * min(1.0, (2 * width + ROWS_TOGETHER) / max(1, n))) // QUERIES_TOGETHER))
    spread = own.select("vec_id", "v")
    there = ranks.join(spread, "vec_id").withColumn("block", F.floor(F.col("rank") / ROWS_TOGETHER).cast("long"))
    there = there.withColumn("portion", F.explode(F.sequence(F.lit(0), F.lit(portions - 1))))
    first, last = (F.floor(F.greatest(F.lit(0), F.col("rank") + w) / ROWS_TOGETHER).cast("long") for w in (-width, width))
    met = ranks.filter(is_query(F.col("vec_id"))).join(spread, "vec_id").withColumn("block", F.explode(F.sequence(first, last)))
    met = met.withColumn("portion", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(portions)).cast("int"))
    met = met.select(*[F.col(c).alias(c) for c in met.columns])
    keys = ["dim", "curve", "block", "portion"]

    def rerank(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(there):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        asked, there = one_per_id(asked, "vec_id"), one_per_id(there, "vec_id")
        return nearest(matrix(asked["v"], "float64"), matrix(there["v"], "float64"), asked["vec_id"].to_numpy(), there["vec_id"].to_numpy(), k)

    found = met.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInPandas(rerank, "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
