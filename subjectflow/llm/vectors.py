"""What the two vector searches share: usable rows, and a query set met with all rows in blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block, about: a block of queries and one of candidates are what one call holds.
BLOCK = 4096


def finite(vector: str) -> Column:
    """True for vectors that are not null and hold neither nulls nor values that are not finite."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return x.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(rows: pd.Series, kind: str) -> np.ndarray:
    """Vectors of one length as a matrix."""
    return np.array(rows.tolist(), dtype=kind).reshape(len(rows), -1)


def one_per_id(frame: pd.DataFrame, key: str) -> pd.DataFrame:
    """Rows in order of their id; of rows that repeat an id, the one with the smallest vector."""
    frame = frame.sort_values(key, kind="stable")
    if frame[key].is_unique:
        return frame
    order = sorted(range(len(frame)), key=lambda i: (frame[key].iat[i], list(frame["v"].iat[i])))
    return frame.iloc[order].drop_duplicates(key)


def met(queries: DataFrame, rows: DataFrame, blocks: int, query_blocks: int, fn: Callable, schema: str) -> DataFrame:
    """Every block of ``queries`` with every block of ``rows`` of the same ``dim``, once.

    ``queries`` and ``rows`` have ``dim`` and ``block``. ``fn`` gets two frames of about
    ``BLOCK`` rows; nothing larger is ever in one task, however the rows are distributed.
    """
    left = queries.withColumnRenamed("block", "qb").withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = rows.withColumnRenamed("block", "cb").withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    # both may come from one table: columns of their own
    left = left.select(*[F.col(c).alias(c) for c in left.columns])
    keys = ["dim", "qb", "cb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(fn, schema)


def blocked(df: DataFrame, key: str, blocks: int) -> DataFrame:
    """Add ``block``: rows dealt out by a hash of their id."""
    return df.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))


def blocks_of(n: int) -> int:
    """Blocks for so many rows."""
    return max(1, -(-n // BLOCK))
