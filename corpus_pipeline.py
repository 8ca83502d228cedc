"""From documents to token ids: quality, toxicity, near copies, source mix, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept;
all but the last return the columns of ``docs``. Classifiers are fitted on those of their
own input's rows whose labels may be learned.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from subjectflow.llm import bpe, mixing, neardup, quality, toxicity
from subjectflow.llm.common import stored, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not found toxic."""
    return toxicity.keep(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.keep(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated and cut to their target weights: a row for each time a document is taken."""
    return mixing.sample(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row's whole text, with digests of the ids and of the text decoded from them."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, ("doc_id", "source"), ids=True)


STAGES = [("quality", good), ("toxicity", civil), ("near_dedup", distinct), ("mixing", mixed), ("bpe", encoded)]

#: Fitted classifiers and BPE are beyond SQL; tests hold the rows against plain versions of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
