"""Dataset, schema and text comparison; controlled terms and conformance checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subjectflow.operators.picks import number_rows
from subjectflow.operators.rules import Rule, check_rules

_TOLERANCE = 2.0**-26  # relative difference below which two numbers count as equal


@dataclass(frozen=True)
class Comparison:
    """Frames of a dataset comparison. All but ``schema`` are views of ``found``: to count
    several of them, aggregate ``found`` once."""

    only_in_base: DataFrame
    only_in_compare: DataFrame
    differences: DataFrame
    by_variable: DataFrame
    schema: DataFrame
    found: DataFrame


def _numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _differs(a: Column, b: Column, numeric: bool, tolerance: float) -> Column:
    if not numeric:
        return ~a.eqNullSafe(b)
    x, y = a.cast("double"), b.cast("double")
    close = (x == y) | (F.abs(x - y) <= F.abs(x) * F.lit(tolerance))
    return ~F.when(x.isNull() | y.isNull(), x.isNull() & y.isNull()).otherwise(close)


def _paired(base: DataFrame, compare: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with both sides as structs; null keys match. A key that occurs twice on
    one side is an error at run time, for its rows have no partners.

    Both tables are stacked and grouped: one shuffle each, no join.
    """
    a = base.select(*keys, F.struct(*base.columns).alias("_b"))
    b = compare.select(*keys, F.struct(*compare.columns).alias("_c"))
    sides = a.unionByName(b, allowMissingColumns=True).groupBy(*keys).agg(
        F.first("_b", ignorenulls=True).alias("_b"), F.first("_c", ignorenulls=True).alias("_c"),
        F.greatest(F.count("_b"), F.count("_c")).alias("_n"),
    )
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    twice = F.raise_error(F.concat(F.lit("duplicate key in comparison: "), shown))
    # the check is part of what is kept, so it can't be pruned
    kept = F.when(F.col("_n") == 1, F.col("_b")).otherwise(twice)
    return sides.select(*keys, kept.alias("_b"), F.when(F.col("_n") == 1, F.col("_c")).otherwise(twice).alias("_c"))


def findings(base: DataFrame, compare: DataFrame, keys: Sequence[str], tolerance: float = _TOLERANCE) -> DataFrame:
    """Everything that differs, in one pass: keys, ``side`` (BASE or COMPARE for a lone row, DIFF
    for a cell), variable, base and compare text."""
    shared = [c for c in base.columns if c in compare.columns and c not in keys]
    both = F.col("_b").isNotNull() & F.col("_c").isNotNull()
    none = F.lit(None).cast("string")

    def entry(side: str, variable: Column, a: Column, b: Column) -> Column:
        return F.struct(F.lit(side).alias("side"), variable.alias("variable"), a.alias("base"), b.alias("compare"))

    cells = [
        F.when(F.col("_c").isNull(), entry("BASE", none, none, none)), F.when(F.col("_b").isNull(), entry("COMPARE", none, none, none)),
    ]
    for c in shared:
        numeric = _numeric(base.schema[c].dataType) and _numeric(compare.schema[c].dataType)
        a, b = F.col(f"_b.{c}"), F.col(f"_c.{c}")
        if base.schema[c].dataType != compare.schema[c].dataType and not numeric:
            a, b = a.cast("string"), b.cast("string")
        cells.append(F.when(both & _differs(a, b, numeric, tolerance), entry("DIFF", F.lit(c), a.cast("string"), b.cast("string"))))
    return _paired(base, compare, keys).select(*keys, F.explode(F.array_compact(F.array(*cells))).alias("_d")).select(*keys, "_d.*")


def value_differences(
    base: DataFrame, compare: DataFrame, keys: Sequence[str], tolerance: float = _TOLERANCE
) -> DataFrame:
    """One row per differing cell of matching records: keys, variable, base and compare text."""
    return findings(base, compare, keys, tolerance).filter("side = 'DIFF'").drop("side")


def lone_keys(base: DataFrame, compare: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found on one side only, with the side (``BASE`` or ``COMPARE``)."""
    return findings(base.select(*keys), compare.select(*keys), keys).select(*keys, "side")


def compare_datasets(
    base: DataFrame, compare: DataFrame, keys: Sequence[str] | None = None, order: Sequence[str] | None = None,
    tolerance: float = _TOLERANCE, unique: bool = False,
) -> Comparison:
    """Compare two tables by key, or by row position in ``order`` when no keys are given.

    By position both tables are numbered first, which runs a small job for each
    (``number_rows``; ``unique``: no rows tie in the order).
    """
    schema = compare_schemas(base, compare)
    if keys is None:
        order = list(order or base.columns)
        base, compare, keys = number_rows(base, order, unique=unique), number_rows(compare, order, unique=unique), ["row_no"]
    found = findings(base, compare, keys, tolerance)
    diffs = found.filter("side = 'DIFF'").drop("side")
    return Comparison(
        only_in_base=found.filter("side = 'BASE'").select(*keys),
        only_in_compare=found.filter("side = 'COMPARE'").select(*keys),
        differences=diffs,
        by_variable=diffs.groupBy("variable").agg(F.count("*").alias("n_differences")),
        schema=schema,
        found=found,
    )


def comparison_status(differences: DataFrame, datasets: Sequence[str], dataset: str = "dataset", allowed: int = 0) -> DataFrame:
    """Pass/fail row per dataset: pass when at most ``allowed`` differences were found."""
    named = differences.sparkSession.createDataFrame([(d,) for d in datasets], f"{dataset} string")
    counted = named.select(dataset, F.lit(0).alias("_n")).unionByName(differences.select(dataset, F.lit(1).alias("_n")))
    n = F.sum("_n").alias("n_differences")
    return counted.groupBy(dataset).agg(n).withColumn("status", F.when(F.col("n_differences") <= allowed, "pass").otherwise("fail"))


# ------------------------------------------------------------------- metadata
def schema_frame(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Column metadata of several tables: dataset, position, name, type, label, format."""
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.metadata.get("label"), f.metadata.get("displayFormat"))
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows, "dataset string, position int, name string, type string, label string, display_format string"
    )


def compare_schemas(base: DataFrame, compare: DataFrame) -> DataFrame:
    """Differences of two schemas: variable, attribute, base and compare value."""
    spark = base.sparkSession
    a = schema_frame(spark, {"t": base}).select("name", F.struct("type", "label", "display_format").alias("_b"))
    b = schema_frame(spark, {"t": compare}).select("name", F.struct("type", "label", "display_format").alias("_c"))
    joined = a.join(b, "name", "full")
    here = lambda side: F.when(F.col(side).isNotNull(), F.lit("present"))
    checks = [("column", here("_b"), here("_c"))]
    both = F.col("_b").isNotNull() & F.col("_c").isNotNull()
    for attribute in ("type", "label", "display_format"):
        checks.append((attribute, F.when(both, F.col(f"_b.{attribute}")), F.when(both, F.col(f"_c.{attribute}"))))
    entries = F.array(*[
        F.when(~x.eqNullSafe(y), F.struct(F.lit(n).alias("attribute"), x.alias("base"), y.alias("compare")))
        for n, x, y in checks
    ])
    return (
        joined.select(F.col("name").alias("variable"), F.explode(entries).alias("_e"))
        .filter(F.col("_e").isNotNull())
        .select("variable", "_e.*")
    )


def filled_cells(df: DataFrame) -> DataFrame:
    """Non-null cells per column (variable, n_filled), counted in one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").alias("n_filled")) for c in df.columns])
    return counts.select(F.explode(rows).alias("_e")).select("_e.*")


def _canonical(c: Column, kind: T.DataType) -> Column:
    """Text of a cell that doesn't depend on how its type prints: numbers in whole thousandths, moments in microseconds."""
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.floor(c.cast("double") * 1000).cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, T.ArrayType):
        return F.array_join(F.transform(c, lambda x: _canonical(x, kind.elementType)), ",", "")
    return c.cast("string")


def cell_digests(df: DataFrame) -> DataFrame:
    """``filled_cells`` with ``digest``, the sum over the cells of 32 bits of their text's md5: one pass."""
    hashed = {f.name: F.conv(F.substring(F.md5(_canonical(F.col(f"`{f.name}`"), f.dataType).cast("binary")), 1, 8), 16, 10).cast("long") for f in df.schema}
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(hashed)], *[F.coalesce(F.sum(h), F.lit(0)).alias(f"d{i}") for i, h in enumerate(hashed.values())])
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"n{i}").alias("n_filled"), F.col(f"d{i}").alias("digest")) for i, c in enumerate(hashed)])
    return counts.select(F.explode(rows).alias("_e")).select("_e.*")


def variable_labels(wanted: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Attach the distinct labels of all tables to a (variable, dataset) list."""
    labels = schema_frame(wanted.sparkSession, tables).select(F.col("name").alias("variable"), "label").distinct()
    return wanted.join(labels, "variable", "left").distinct()


#: Rule ids of the conformance report. ``columns`` has the described columns with what the standard expects.
CONFORMANCE = (
    Rule("AD0018", "columns", "standard_label IS NULL OR label <=> standard_label", "label differs from the standard"),
    Rule("AD0041A", "columns", "NOT endswith(name, 'DT') OR display_format IS NOT NULL", "date column without a display format"),
    Rule("SD0059", "columns", "standard_type IS NULL OR type = standard_type", "type differs from the standard"),
    Rule("AD0320", "datasets", "label <=> standard_label", "dataset label differs from the standard"),
)


def conformance(columns: DataFrame, standard: DataFrame, datasets: DataFrame | None = None, rules: Sequence[Rule] = CONFORMANCE) -> DataFrame:
    """Rule violations counted per rule and dataset.

    ``columns`` describes the data (dataset, name, type, label, display_format),
    ``standard`` the expected name, label and type, ``datasets`` the dataset labels
    (dataset, label, standard_label). The rules are rows; others may be passed.
    """
    expected = standard.select("name", F.col("label").alias("standard_label"), F.col("type").alias("standard_type"))
    tables = {"columns": columns.join(expected, "name", "left")} | ({} if datasets is None else {"datasets": datasets})
    found = check_rules(tables, [r for r in rules if r.scope in tables], dict.fromkeys(tables, "dataset"))
    return found.select("rule", "dataset", "n")


def codelist_offenders(
    df: DataFrame, column: str, codelist: DataFrame, code: str = "code", missing_allowed: bool = True
) -> DataFrame:
    """Distinct values (with counts) that are not in the codelist."""
    values = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_rows"))
    allowed = codelist.select(F.col(code).alias("value"))
    if not missing_allowed:
        bad = values.join(allowed, "value", "left_anti")
    else:
        bad = values.filter(F.col("value").isNotNull()).join(allowed, "value", "left_anti")
    return bad.select(F.lit(column).alias("variable"), F.col("value").cast("string").alias("value"), "n_rows")


# ----------------------------------------------------------------------- text
def text_lines(df: DataFrame, key: Sequence[str], text: str = "text") -> DataFrame:
    """Numbered lines (from 1) of each text."""
    return df.select(*key, F.posexplode(F.split(F.col(text), "\n")).alias("_i", "line")).select(
        *key, (F.col("_i") + 1).alias("line_no"), "line"
    )


def text_differences(base: DataFrame, compare: DataFrame, key: Sequence[str]) -> DataFrame:
    """Lines that differ by (key, line number); a line missing on one side is null there."""
    keys = [*key, "line_no"]
    a = base.select(*keys, F.col("line").alias("base_line"))
    b = compare.select(*keys, F.col("line").alias("compare_line"))
    return a.join(b, keys, "full").filter(~F.col("base_line").eqNullSafe(F.col("compare_line")))


def text_status(base: DataFrame, compare: DataFrame, key: Sequence[str], allowed: int = 1) -> DataFrame:
    """Per text: differing lines and pass/fail; one differing line (a time stamp) may pass."""
    keys = [*key, "line_no"]
    a = base.select(*keys, F.col("line").alias("_b"))
    b = compare.select(*keys, F.col("line").alias("_c"))
    counted = a.join(b, keys, "full").groupBy(*key).agg(
        F.count_if(~F.col("_b").eqNullSafe(F.col("_c"))).alias("n_differences")
    )
    return counted.withColumn("status", F.when(F.col("n_differences") <= allowed, "pass").otherwise("fail"))


def parse_fenced_pairs(df: DataFrame, key: Sequence[str], text: str = "text", header: str = "Variable,Dataset") -> DataFrame:
    """Rows of a comma-separated block inside a fenced text.

    The first line and the fences go, a header line may be present or not, and blank
    lines are skipped.
    """
    body = F.regexp_replace(F.col(text), r"^[^\n]*\n", "")
    body = F.replace(F.replace(body, F.lit("\n```"), F.lit("")), F.lit(header + "\n"), F.lit(""))
    lines = df.select(*key, F.explode(F.split(body, "\n")).alias("_line")).filter(F.trim("_line") != "")
    parts = F.split("_line", ",")
    return lines.select(*key, F.get(parts, 0).alias("variable"), F.get(parts, 1).alias("dataset"))
