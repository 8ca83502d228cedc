"""Registry of named queries with their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from subjectflow.plans.analogs import forget_tables
from subjectflow.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function under ``name``."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            forget_tables()
            return fn(tune(spark), sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
