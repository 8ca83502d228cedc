"""Loading named tables, text lines, definition labels and folder conversion."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectflow.functions.cells import blanks_to_null
from subjectflow.operators.spec import profile_columns
from subjectflow.sources.dataset_json import read_dataset_json, read_dataset_ndjson, write_dataset_ndjson
from subjectflow.sources.splits import numbered_lines

#: Tables that a folder conversion writes at the same time.
AT_ONCE = 8


def load_tables(
    spark: SparkSession, folder: str, names: Iterable[str], fmt: str = "parquet", blanks_as_null: bool = False,
    views: bool = False,
) -> dict[str, DataFrame]:
    """Several named tables of one folder as a dictionary of lazy frames.

    ``fmt`` is ``parquet``, ``dataset-json`` (name.json), ``dataset-ndjson`` (folder) or
    any other Spark source. ``views`` also registers temporary views.
    """
    tables = {}
    for name in dict.fromkeys(names):
        if fmt == "dataset-json":
            df = read_dataset_json(spark, f"{folder}/{name}.json")
        elif fmt == "dataset-ndjson":
            df = read_dataset_ndjson(spark, f"{folder}/{name}")
        elif fmt == "parquet":
            df = spark.read.parquet(f"{folder}/{name}.parquet")
        else:
            df = spark.read.format(fmt).load(f"{folder}/{name}")
        tables[name] = blanks_to_null(df) if blanks_as_null else df
        if views:
            tables[name].createOrReplaceTempView(name)
    return tables


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of report files with file name and line number; large files are read split by split."""
    return numbered_lines(spark, path).select("file", "line_no", "line")


def define_labels(spark: SparkSession, path: str) -> DataFrame:
    """Dataset names and labels of a metadata XML file."""
    xml = spark.read.format("xml").option("rowTag", "ItemGroupDef").schema(
        "_OID string, _Label string, `_def:Label` string"
    ).load(path)
    return xml.select(F.col("_OID").alias("oid"), F.coalesce("_Label", "_def:Label").alias("label"))


def convert_folder(
    spark: SparkSession, tables: Mapping[str, DataFrame], target: str, labels: Mapping[str, str] | None = None,
    skip: str = r"(^|[^a-z])ts$", names: Sequence[str] | None = None,
) -> DataFrame:
    """Write each table as line-delimited Dataset-JSON below ``target`` and return the column profiles.

    Names matching ``skip`` are left out. The object id is the lower-case table name.
    """
    chosen = [name for name in names or tables if not re.search(skip, name.lower())]

    def write(name: str) -> None:
        write_dataset_ndjson(tables[name], f"{target}/{name.lower()}", name.lower(), (labels or {}).get(name.lower(), ""))

    with ThreadPoolExecutor(AT_ONCE) as pool:  # small tables don't fill a cluster: their jobs run side by side
        list(pool.map(write, chosen))
    profiles = None
    for name in chosen:
        part = profile_columns(tables[name]).select(F.lit(name.lower()).alias("dataset"), "*")
        profiles = part if profiles is None else profiles.unionByName(part)
    return profiles
