"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectflow.session import shared_dir

#: A word everywhere in this package: a run without a blank or a control blank.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, outlives executors."""
    path = folder or scratch(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder (``spark.checkpoint.dir``)."""
    return f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


#: Rows that go to a Python worker at once.
BATCH = 500


def whole_texts(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """``docs.select(*columns)`` for a Python function over whole texts.

    Texts may be long and a worker holds a batch in several forms, so batches are made
    smaller than Spark's default of 10,000 rows (a setting of the session).
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH:
        conf.set(key, str(BATCH))
    return docs.select(*columns)


_KEPT: dict[tuple, object] = {}


def kept_by_worker(key: tuple, make: Callable[[], object] | None = None):
    """What one operator keeps in a Python worker from task to task.

    Workers outlive their tasks and serve all operators in turn, so a worker keeps the tables
    of the operator that it served last and no other: a call with another key drops them
    (without ``make``: drops whatever there is).
    """
    if key not in _KEPT:
        _KEPT.clear()
        if make is None:
            return None
        _KEPT[key] = make()
    return _KEPT[key]


def labelled_sample(spark: SparkSession, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """``doc_id``, ``label`` of the rows that may be learned from, about ``bound`` at most.

    Only rows whose crc32 of the id's digits is not divisible by five and whose label is
    not null; one label per document (the larger, if they disagree). Above the bound,
    the ids with the smallest hashes are kept: a threshold on the hash, no sort.
    """
    usable = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    n = usable.count()
    if n > bound:
        usable = usable.filter(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) < int(bound / n * (1 << 30)))
    return usable


def held_out() -> Column:
    """True for rows that labels are never learned from (a null id: false)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def small_join(df: DataFrame, small: DataFrame, by: list[str], bound: int, how: str = "inner") -> DataFrame:
    """Join a table that is broadcast only if its counted rows are within ``bound``."""
    if small.limit(bound + 1).count() <= bound:
        small = F.broadcast(small)
    return df.join(small, by, how)
