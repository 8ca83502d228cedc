"""A left join of many rows to one row per key that survives hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_types(a: DataFrame, b: DataFrame, by: Sequence[str]) -> dict[str, T.DataType]:
    """The type to which Spark itself would widen each key (schema of a union; no job)."""
    kinds = a.select(*by).union(b.select(*by)).schema
    for field in kinds:
        if isinstance(field.dataType, T.StringType) and getattr(field.dataType, "collationId", 0):
            raise ValueError(f"join key {field.name} has a collation: equal texts may have different hashes")
    return {k: kinds[i].dataType for i, k in enumerate(by)}


def lookup_join(
    df: DataFrame, one_per_key: DataFrame, by: Sequence[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join columns of a table that holds one row per key (``how``: left or inner).

    Adaptive execution splits a hot key's partition only if both join inputs come
    straight out of a shuffle made for the join. A side that was just aggregated by the
    key already has the right partitioning and gets no such shuffle, so the hot key
    would stay in one task. The redundant hash in the condition asks for a shuffle of
    its own: the small side moves once more, the split becomes possible. A small enough
    side is still broadcast, by its measured size.

    Keys of different types are compared, and hashed, in their common type. A null key
    matches nothing, or with ``null_safe`` another null key.
    """
    by = list(by)
    others = [c for c in one_per_key.columns if c not in by]
    kinds = common_types(df, one_per_key, by)
    right = one_per_key.select(*[F.col(k).cast(kinds[k]).alias(f"_j_{k}") for k in by], *others)
    left_keys, right_keys = [F.col(k).cast(kinds[k]) for k in by], [F.col(f"_j_{k}") for k in by]
    test = F.xxhash64(*left_keys) == F.xxhash64(*right_keys)
    for a, b in zip(left_keys, right_keys, strict=True):
        test = test & (a.eqNullSafe(b) if null_safe else a == b)
    return df.join(right, test, how).drop(*[f"_j_{k}" for k in by])
