"""Table specifications: column descriptors and conforming a table to its spec."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subjectflow.functions.cells import nulls_to_blank


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = "text"
    length: int | None = None
    label: str | None = None
    format: str | None = None
    key: int | None = None
    codelist: tuple = ()


@dataclass(frozen=True)
class TableSpec:
    name: str
    label: str = ""
    columns: Sequence[ColumnSpec] = field(default_factory=tuple)

    @property
    def keys(self) -> list[str]:
        keyed = [c for c in self.columns if c.key is not None]
        return [c.name for c in sorted(keyed, key=lambda c: c.key)]


def select_dataset(spec: DataFrame, dataset: str, column: str = "dataset") -> DataFrame:
    """The rows of a metadata table that describe one dataset."""
    return spec.filter(F.upper(F.col(column)) == dataset.upper())


def column_descriptors(ds_vars: DataFrame, var_spec: DataFrame) -> DataFrame:
    """Dataset-JSON column descriptors from a variable list and its attributes.

    ``ds_vars``: dataset, variable, key_seq. ``var_spec``: variable, type, length,
    label, format. Rules in order: date format, datetime format, ``DTC`` name of length
    8 or 20, text, else the given type; a length is kept only for strings.
    """
    joined = ds_vars.select("dataset", "variable", "key_seq").join(var_spec, "variable", "left")
    dtc = F.col("variable").endswith("DTC")
    kind = (
        F.when(F.col("format") == "DATE9.", "date")
        .when(F.col("format") == "DATETIME20.", "datetime")
        .when(dtc & (F.col("length") == 8), "date")
        .when(dtc & (F.col("length") == 20), "datetime")
        .when(F.col("type") == "text", "string")
        .otherwise(F.col("type"))
    )
    return joined.select(
        F.concat(F.lit("IT."), "dataset", F.lit("."), "variable").alias("itemOID"),
        F.col("variable").alias("name"),
        "label",
        kind.alias("dataType"),
        F.when(kind == "string", F.col("length")).alias("length"),
        F.col("key_seq").alias("keySequence"),
        F.col("format").alias("displayFormat"),
        F.when(F.col("format").isin("DATE9.", "DATETIME20."), F.lit("integer")).alias("targetDataType"),
    )


def descriptor_kind(name: str, given: str | None, length: int | None, fmt: str | None, found: str) -> str:
    """The rules of ``column_descriptors`` for one column that is written; ``found``: the class of
    its data, which decides where a rule would not fit what the cells hold."""
    if found == "string":
        if name.endswith("DTC") and length in (8, 20):
            return "date" if length == 8 else "datetime"
        return "string"
    if found == "date" and fmt == "DATETIME20.":
        return "datetime"
    return given if found == "integer" and given in ("integer", "float", "decimal") else found


def display_format(text: str | None) -> str | None:
    """Stored display format: blank becomes none, the date format loses its dot."""
    if not text:
        return None
    return "DATE9" if text == "DATE9." else text


def conform(df: DataFrame, spec: TableSpec, blanks: bool = True, sort: bool = False) -> DataFrame:
    """Keep the spec's columns in spec order and attach labels and formats.

    Metadata is attached in the last projection, because any expression drops it.
    ``sort`` orders by the spec key; use it only right before writing.
    """
    known = [c for c in spec.columns if c.name in df.columns]
    out = df.select(*[c.name for c in known])
    if blanks:
        out = nulls_to_blank(out)
    if sort and spec.keys:
        out = out.orderBy(*[F.col(k).asc_nulls_last() for k in spec.keys if k in out.columns])
    cells = []
    for c in known:
        metadata = {"label": c.label, "displayFormat": display_format(c.format), "length": c.length, "keySequence": c.key}
        cells.append(F.col(c.name).alias(c.name, metadata={k: v for k, v in metadata.items() if v is not None}))
    return out.select(*cells)


def codelist_check(df: DataFrame, spec: TableSpec, missing_allowed: bool = True) -> DataFrame:
    """Values outside the codelists of the spec: variable, value, n_rows.

    All coded columns are checked in one pass; codelists are literals of the spec.
    """
    coded = [c for c in spec.columns if c.codelist and c.name in df.columns]
    cells = []
    for c in coded:
        value = F.col(c.name).cast("string")
        bad = ~value.isin([str(v) for v in c.codelist])
        bad = F.coalesce(bad, F.lit(not missing_allowed))
        cells.append(F.when(bad, F.struct(F.lit(c.name).alias("variable"), value.alias("value"))))
    if not cells:
        return df.sparkSession.createDataFrame([], "variable string, value string, n_rows long")
    hits = df.select(F.explode(F.array(*cells)).alias("_e")).filter(F.col("_e").isNotNull())
    return hits.groupBy("_e.variable", "_e.value").agg(F.count("*").alias("n_rows"))


_CLASSES = [
    (T.DateType, "date"), (T.TimestampType, "datetime"), (T.TimestampNTZType, "datetime"), (T.DoubleType, "float"),
    (T.FloatType, "float"), (T.DecimalType, "decimal"), (T.BooleanType, "boolean"), (T.IntegralType, "integer"),
]


def data_class(kind: T.DataType) -> str:
    """Dataset-JSON data type of a Spark type."""
    for cls, name in _CLASSES:
        if isinstance(kind, cls):
            return name
    return "string"


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, name, data type, longest text (at least 1), label, format.

    One aggregate over all text columns; other columns are not read.
    """
    fields = df.schema.fields
    text = [f for f in fields if isinstance(f.dataType, T.StringType)]
    lengths = df.agg(F.lit(1).alias("_one"), *[
        F.greatest(F.coalesce(F.max(F.length(F.col(f"`{f.name}`"))), F.lit(1)), F.lit(1)).alias(f"_{f.name}") for f in text
    ])
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(data_class(f.dataType)).alias("data_type"),
            (F.col(f"`_{f.name}`") if f in text else F.lit(None)).cast("int").alias("length"),
            F.lit(f.metadata.get("label")).cast("string").alias("label"),
            F.lit(f.metadata.get("displayFormat")).cast("string").alias("display_format"),
        )
        for i, f in enumerate(fields, start=1)
    ])
    return lengths.select(F.explode(rows).alias("_e")).select("_e.*")
