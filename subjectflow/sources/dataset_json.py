"""Dataset-JSON as a source and a sink.

A classic Dataset-JSON file is one JSON object. Spark's reader takes it whole in one task, which
will do for small files; ``read_dataset_json_split`` cuts large ones into byte ranges.
The line-delimited layout splits: the metadata object is the first line and each further
line is one positional array. Written in parallel it is a folder with the first line in
``metadata`` and the others in ``rows``; its files in this order are one valid file, and
single files are read as well. Numbers and booleans are JSON literals; decimals, dates and
text are JSON strings.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subjectflow.operators.spec import TableSpec, data_class, descriptor_kind, display_format
from subjectflow.sources.splits import json_elements, rows_of, whole_array

_COLUMN = (
    "struct<itemOID:string,name:string,label:string,dataType:string,targetDataType:string,length:int,"
    "keySequence:int,displayFormat:string>"
)
_META = (
    "datasetJSONCreationDateTime string, datasetJSONVersion string, itemGroupOID string, records long, "
    f"name string, label string, columns array<{_COLUMN}>"
)


def _spark_type(column, decimals_as_floats: bool) -> str:
    kind = column["dataType"]
    if kind == "decimal":
        return "double" if decimals_as_floats else "decimal(38,18)"
    return {
        "integer": "bigint", "float": "double", "double": "double", "boolean": "boolean", "date": "date",
        "datetime": "timestamp_ntz", "time": "time",
    }.get(kind, "string")


def _refused(text: Column, column) -> Column:
    """Fail at run time: the number does not fit the column's type."""
    return F.raise_error(F.concat(F.lit(f"column {column['name']} can't hold the number "), text))


def _odd_whole(text: Column, column) -> Column:
    """Other text of whole numbers: zeros behind the point are dropped and an exponent written out;
    any other number would change, so it is refused.

    Within a lambda, so that none of it is worked out for cells that don't come here.
    """

    def value(x: Column) -> Column:
        near = x.try_cast("double")
        whole = F.when(x.rlike("[eE]") & (near == F.floor(near)) & (F.abs(near) <= 2.0**53), near.cast("bigint"))
        found = F.coalesce(F.regexp_replace(x, r"\.0*$", "").try_cast("bigint"), whole)
        return F.when(found.isNull() & near.isNotNull(), _refused(x, column)).otherwise(found)

    return F.get(F.transform(F.array(text), value), F.lit(0))


def _typed(cell: Column, column, decimals_as_floats: bool) -> Column:
    kind = _spark_type(column, decimals_as_floats)
    text = F.trim(cell)
    if kind == "bigint":
        # plain digits, as nearly all are, are taken as they stand
        value = F.coalesce(cell.try_cast("bigint"), _odd_whole(text, column))
    elif kind == "string":
        value = cell
    elif kind.startswith("decimal"):
        value, near = text.try_cast(kind), text.try_cast("double")
        exact = F.abs(value.cast("double") - near) <= F.abs(near) * F.lit(1e-15)
        value = F.when(near.isNotNull() & ~F.coalesce(exact, F.lit(False)), _refused(text, column)).otherwise(value)
    elif kind == "time":
        part = [F.try_element_at(F.split(text, ":"), F.lit(i)).try_cast("double") for i in (1, 2, 3)]
        value = part[0] * 3600 + part[1] * 60 + F.coalesce(part[2], F.lit(0.0))
    else:
        value = text.try_cast(kind)
    metadata = {k: column[k] for k in ("label", "displayFormat", "length", "keySequence") if column[k] is not None}
    return value.alias(column["name"], metadata=metadata)


def _project(rows: DataFrame, cells: str, columns, decimals_as_floats: bool) -> DataFrame:
    return rows.select(*[_typed(F.get(F.col(cells), i), c, decimals_as_floats) for i, c in enumerate(columns)])


def read_dataset_json(spark: SparkSession, path: str, decimals_as_floats: bool = True) -> DataFrame:
    """Read a classic Dataset-JSON file; cells that do not parse become null."""
    reader = spark.read.option("multiLine", True)
    columns = reader.schema(_META).json(path).select("columns").first()["columns"]
    rows = reader.schema("rows array<array<string>>").json(path).select(F.explode("rows").alias("_r"))
    return _project(rows, "_r", columns, decimals_as_floats)


def read_dataset_json_split(spark: SparkSession, path: str, decimals_as_floats: bool = True) -> DataFrame:
    """Read classic files of any size, each cut into byte ranges that many tasks read.

    The same rows as ``read_dataset_json``. Files of one call must have the same columns. The
    rows' texts are written to the shared folder once, to be read for the columns and the cells.
    """
    elements = json_elements(spark, path)
    described = whole_array(elements, "columns").select(F.from_json("array", f"array<{_COLUMN}>").alias("columns")).distinct()
    found = described.limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{'no' if not found else 'different'} columns in the files of {path}")
    rows = rows_of(elements, "rows").select(F.from_json("row", "array<string>").alias("_r"))
    return _project(rows, "_r", found[0]["columns"], decimals_as_floats)


def read_dataset_ndjson(spark: SparkSession, path: str, decimals_as_floats: bool = True) -> DataFrame:
    """Read the line-delimited layout; the row files split across tasks."""
    columns = spark.read.schema(_META).json(f"{path}/metadata").select("columns").first()["columns"]
    lines = spark.read.text(f"{path}/rows")
    rows = lines.select(F.from_json("value", "array<string>").alias("_r"))
    return _project(rows, "_r", columns, decimals_as_floats)


def read_ndjson_file(spark: SparkSession, path: str, decimals_as_floats: bool = True) -> DataFrame:
    """Read one line-delimited file (or a folder of its parts): metadata line, then rows."""
    lines = spark.read.text(path)
    meta = lines.filter(F.ltrim("value").startswith("{")).select(F.from_json("value", _META).alias("_m")).select("_m.columns")
    rows = lines.filter(F.ltrim("value").startswith("[")).select(F.from_json("value", "array<string>").alias("_r"))
    return _project(rows, "_r", meta.first()["columns"], decimals_as_floats)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The metadata object of a line-delimited Dataset-JSON folder."""
    return spark.read.schema(_META).json(f"{path}/metadata")


def _described(df: DataFrame, name: str, spec: TableSpec | None) -> list[dict]:
    given = {c.name: c for c in spec.columns} if spec else {}
    out = []
    for f in df.schema.fields:
        c = given.get(f.name)
        fmt = c.format if c else f.metadata.get("displayFormat")
        kind = descriptor_kind(f.name, c.type if c else None, c.length if c else None, fmt, data_class(f.dataType))
        entry = {
            "itemOID": f"IT.{name.upper()}.{f.name}",
            "name": f.name,
            "label": (c.label if c else None) or f.metadata.get("label") or f.name,
            "dataType": "decimal" if kind == "float" else kind,
            "targetDataType": {"float": "decimal", "date": "integer", "datetime": "integer"}.get(kind),
            "length": (c.length if c else f.metadata.get("length")) if kind == "string" else None,
            "keySequence": c.key if c else f.metadata.get("keySequence"),
            "displayFormat": display_format(fmt),
        }
        out.append({k: v for k, v in entry.items() if v is not None})
    return out


def _cell(f: T.StructField) -> Column:
    """JSON text of one cell: a literal for integers and booleans, else a string; null stays null."""
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.IntegralType, T.BooleanType)):
        return F.coalesce(c.cast("string"), F.lit("null"))
    if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
        c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
        c = F.to_json(c)
    if isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.TimestampNTZType)):  # nothing to escape
        quoted = F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
        return F.coalesce(quoted, F.lit("null"))
    quoted = F.to_json(F.array(c.cast("string")))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.substring(quoted, 2, F.length(quoted) - 2))


def write_dataset_ndjson(
    df: DataFrame, path: str, name: str, label: str = "", spec: TableSpec | None = None, created: str | None = None,
    records: int | None = None, mode: str = "errorifexists",
) -> str:
    """Write the line-delimited layout: every task writes its own rows.

    Floats are written as decimal text so that they read back exactly. ``records`` is
    counted while the rows are written when it is not given.
    """
    spark = df.sparkSession
    row = F.concat(F.lit("["), F.concat_ws(",", *[_cell(f) for f in df.schema.fields]), F.lit("]"))
    counted = Observation()
    lines = df.select(row.alias("value")).observe(counted, F.count(F.lit(1)).alias("n"))
    lines.write.mode(mode).text(f"{path}/rows")
    if records is None:
        records = counted.get["n"]
    meta = {
        "datasetJSONCreationDateTime": created,
        "datasetJSONVersion": "1.1.0",
        "itemGroupOID": f"IG.{name.upper()}",
        "records": records,
        "name": name.upper(),
        "label": label or (spec.label if spec else ""),
        "columns": _described(df, name, spec),
    }
    line = spark.createDataFrame([(json.dumps({k: v for k, v in meta.items() if v is not None}),)], "value string")
    line.write.mode(mode).text(f"{path}/metadata")
    return path
