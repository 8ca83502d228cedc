"""Grouped descriptive statistics, category counts and report rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subjectflow.functions.cells import col


def long_values(df: DataFrame, by: Sequence[str], layers: Sequence[tuple[str, str | Column, Column | None]]) -> DataFrame:
    """(layer number, layer, by..., value): one row per matching layer and non-null value.

    A layer is (label, value, row condition). Rows matching no layer vanish before any
    shuffle.
    """
    entries = []
    for i, (label, value, where) in enumerate(layers, start=1):
        v = col(value).cast("double")
        if where is not None:
            v = F.when(where, v)
        entries.append(F.struct(F.lit(i).alias("layer_no"), F.lit(label).alias("layer"), v.alias("value")))
    exploded = df.select(*by, F.explode(F.array(*entries)).alias("_e"))
    return exploded.filter(F.col("_e.value").isNotNull()).select(*by, "_e.layer_no", "_e.layer", "_e.value")


_PER_OCTAVE = 2048
_ABOVE_ALL = 10_000_000  # more than the bucket number of any positive double


def _log_bucket(v: Column) -> Column:
    """Monotone integer bucket of a double; the number of buckets is bounded for any data."""
    size = F.lit(_ABOVE_ALL) + F.floor(F.log2(F.abs(v)) * _PER_OCTAVE)
    size = F.when(F.abs(v) == F.lit(float("inf")), 2 * _ABOVE_ALL).otherwise(size)
    return F.when(F.isnan(v), 2 * _ABOVE_ALL + 1).when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0)).cast("int")


def _ranks() -> tuple[Column, Column]:
    """The two middle ranks (equal for an odd count)."""
    return F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1


def _measured(long: DataFrame, by: Sequence[str], value: str, moments: bool) -> DataFrame:
    """Median per group, with n, mean, sd, min and max when ``moments``; see ``exact_median``.

    Everything is one chain: the moments of the buckets are merged next to the running
    count and ride along, so the rows are read once for all of them and once more for
    the values near the middle.
    """
    by = list(by)
    bucket = [*by, "_b"]
    whole = Window.partitionBy(*by)

    rows = long.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"), _log_bucket(F.col(value)).alias("_b"))
    measures = [F.count("*").alias("_size")]
    if moments:
        measures += [F.avg("_v").alias("_bm"), F.var_pop("_v").alias("_bv"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    sizes = rows.groupBy(*bucket).agg(*measures).withColumn("_n", F.sum("_size").over(whole))
    keep = ["_n"]
    if moments:
        sizes = sizes.withColumn("_mean", F.sum(F.col("_size") * F.col("_bm")).over(whole) / F.col("_n"))
        off = F.col("_bm") - F.col("_mean")
        spread = F.sum(F.col("_size") * (F.col("_bv") + off * off)).over(whole)
        sizes = sizes.withColumns({
            "_sd": F.when(F.col("_n") > 1, F.sqrt(spread / (F.col("_n") - 1))),
            "_min": F.min("_lo").over(whole),
            "_max": F.max("_hi").over(whole),
        })
        keep += ["_mean", "_sd", "_min", "_max"]
    running = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(running), F.lit(0)))
    lower, upper = _ranks()

    def holds(rank: Column) -> Column:
        return (rank > F.col("_before")) & (rank <= F.col("_before") + F.col("_size"))

    hits = sizes.filter(holds(lower) | holds(upper)).select(*bucket, "_before", *keep)

    # What is known of the bucket travels as grouping keys, so it is worked out only once.
    near = rows.join(hits, bucket, "inner")
    counts = near.groupBy(*bucket, "_before", *keep, "_v").agg(F.count("*").alias("_c"))
    order = Window.partitionBy(*bucket).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_last", F.col("_before") + F.sum("_c").over(order))
    ranked = ranked.withColumn("_first", F.col("_last") - F.col("_c") + 1)

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_first")) & (rank <= F.col("_last")), F.col("_v")))

    same = [F.max(c).alias(c.lstrip("_")) for c in keep]
    return ranked.groupBy(*by).agg(((at(lower) + at(upper)) / 2).alias("median"), *same)


def exact_median(
    long: DataFrame, by: Sequence[str], value: str = "value", name: str = "median"
) -> DataFrame:
    """Exact median per group without holding or moving a group.

    First pass: rows per logarithmic bucket (thousands per factor of two), combined on the
    map side; a running count over the bounded set of buckets finds the bucket(s) of the
    two middle ranks. Second pass: only the rows of those buckets collapse to counts per
    value, and those few values are ordered. The list of hits has at most two rows per
    group and is broadcast only if its measured size allows.
    """
    return _measured(long, by, value, moments=False).select(*by, F.col("median").alias(name))


def describe_long(long: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """n, mean, sd, median, minimum and maximum per group; nulls are left out.

    Groups without any value do not appear.
    """
    return _measured(long, by, value, moments=True).select(*by, "n", "mean", "sd", "median", "min", "max")


def describe(df: DataFrame, by: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Descriptive statistics of several numeric variables per group."""
    long = long_values(df, by, [(v, v, None) for v in variables]).withColumnRenamed("layer", "variable")
    return describe_long(long, [*by, "variable"])


def category_counts(
    df: DataFrame, arm: str, arms: Sequence[str], levels: Mapping[str, Sequence[str]], name: str = "n"
) -> DataFrame:
    """Counts per arm, variable and fixed level, zero cells included.

    Values outside the level lists are not counted.
    """
    grid = df.sparkSession.createDataFrame(
        [(a, v, i, level) for a in arms for v, values in levels.items() for i, level in enumerate(values, start=1)],
        f"`{arm}` string, variable string, level_no int, level string",
    )
    cells = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("string").alias("level")) for v in levels])
    counts = (
        df.filter(F.col(arm).isin(list(arms)))
        .select(arm, F.explode(cells).alias("_e"))
        .groupBy(arm, F.col("_e.variable").alias("variable"), F.col("_e.level").alias("level"))
        .agg(F.count("*").alias("_n"))
    )
    return grid.join(counts, [arm, "variable", "level"], "left").select(
        arm, "variable", "level_no", "level", F.coalesce("_n", F.lit(0)).cast("long").alias(name)
    )


def population_n(
    df: DataFrame, arm: str, subject: str, where: Column | None = None, name: str = "n", arms: Sequence[str] | None = None
) -> DataFrame:
    """Distinct subjects per arm in the population; ``arms`` adds arms with none."""
    pool = df if where is None else df.filter(where)
    counts = pool.groupBy(arm).agg(F.count_distinct(subject).alias(name))
    if arms is None:
        return counts
    grid = df.sparkSession.createDataFrame([(a,) for a in arms], f"`{arm}` string")
    return grid.join(counts, arm, "left").select(arm, F.coalesce(name, F.lit(0)).cast("long").alias(name))


def grouped_summary(df: DataFrame, by: Sequence[str], stats: Mapping[str, Column], where: Column | None = None) -> DataFrame:
    """Named aggregates per group over the rows meeting ``where``."""
    pool = df if where is None else df.filter(where)
    return pool.groupBy(*by).agg(*[c.alias(n) for n, c in stats.items()])


def layered_summary(
    df: DataFrame, arm: str, arms: Sequence[str], layers: Sequence[tuple[str, str | Column, Column | None]]
) -> DataFrame:
    """The same statistics for several (label, value, condition) layers, per listed arm."""
    rows = df.filter(F.col(arm).isin(list(arms)))
    return describe_long(long_values(rows, [arm], layers), ["layer_no", "layer", arm])


def pivot_wide(
    df: DataFrame, ids: Sequence[str], names_from: str, names: Sequence[str], value: str, fill=None, pattern: str = "%s"
) -> DataFrame:
    """Long to wide: one column per listed name (``pattern`` shapes it), gaps filled.

    The names are given, so no extra job looks for them and the reduction is one
    map-side combined aggregate.
    """
    cells = []
    for n in names:
        c = F.max(F.when(F.col(names_from) == n, F.col(value)))
        cells.append((c if fill is None else F.coalesce(c, F.lit(fill))).alias(pattern.replace("%s", str(n))))
    return df.groupBy(*ids).agg(*cells)


def pivot_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    """Wide to long: one row per listed column."""
    return df.unpivot(list(ids), list(columns), name, value)


def stat_rows(
    summary: DataFrame, arm: str, arms: Sequence[str], stats: Sequence[tuple[str, Column]], prefix: str = "var1_",
    keys: Sequence[str] = ("layer_no", "layer"),
) -> DataFrame:
    """Statistics to report rows: one row per layer and statistic, one column per arm."""
    # The texts are computed in a projection of their own, before the rows are unfolded.
    texts = summary.select(*keys, arm, *[text.alias(f"_t{i}") for i, (_, text) in enumerate(stats, start=1)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("ord_layer_2"), F.lit(label).alias("row_label2"), F.col(f"_t{i}").alias("text"))
        for i, (label, _) in enumerate(stats, start=1)
    ])
    tall = texts.select(*keys, arm, F.explode(rows).alias("_e")).select(*keys, arm, "_e.*")
    cells = [F.max(F.when(F.col(arm) == a, F.col("text"))).alias(f"{prefix}{a}") for a in arms]
    return tall.groupBy(*keys, "ord_layer_2", "row_label2").agg(*cells)


def nest_row_labels(
    rows: DataFrame, group: str = "row_label1", label: str = "row_label2", group_order: str = "ord_layer_index",
    inner_order: Sequence[str] = ("ord_layer_1", "ord_layer_2"), prefix: str = "var",
) -> DataFrame:
    """Put one stub row per group before its rows and merge both labels into one column.

    Missing cells of the columns starting with ``prefix`` print blank. The result keeps
    the order columns; sort by them when writing.
    """
    stubs = rows.select(F.col(group).alias("row_label"), group_order).distinct()
    for c in inner_order:
        stubs = stubs.withColumn(c, F.lit(0).cast(rows.schema[c].dataType))
    body = rows.drop(group).withColumnRenamed(label, "row_label")
    nested = body.unionByName(stubs, allowMissingColumns=True)
    blanks = [c for c in nested.columns if c.startswith(prefix)]
    return nested.fillna("", subset=blanks)


def pad_rows(rows: DataFrame, n: int = 1, order: str = "ord") -> DataFrame:
    """Append ``n`` blank rows after the last row in ``order``."""
    numbers = rows.agg(F.max(order).alias("_top")).select(F.explode(F.sequence(F.lit(1), F.lit(n))).alias("_i"), "_top")
    blank = numbers.select(*[
        (F.col("_top") + F.col("_i")).cast(f.dataType).alias(f.name) if f.name == order
        else F.lit("" if f.dataType.typeName() == "string" else None).cast(f.dataType).alias(f.name)
        for f in rows.schema.fields
    ])
    return rows.unionByName(blank)


def arm_header(
    df: DataFrame, arm: str, arm_order: str, counts: DataFrame, n: str = "n", pattern: str = "|%s\\line(N=%s)",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """One header text: the arms in order, each with its population count.

    With ``names``, the arms of the report, the counts go to fixed places of one row. Without
    them the arms that occur are gathered into it, which suits columns of few values only.
    """
    if names is not None:
        found = counts.filter(F.col(arm).isin(list(names))).agg(*[F.max(F.when(F.col(arm) == a, F.col(n))).alias(f"_{i}") for i, a in enumerate(names)])
        texts = [F.format_string(pattern, F.lit(a), F.coalesce(F.col(f"_{i}"), F.lit(0)).cast("string")) for i, a in enumerate(names)]
        return found.select(F.concat(*texts).alias("header"))
    arms = df.filter(F.col(arm).isNotNull()).select(arm, arm_order).distinct()
    labelled = arms.join(counts, arm, "left").select(
        F.struct(F.col(arm_order), F.format_string(pattern, F.col(arm), F.col(n).cast("string")).alias("text")).alias("_h")
    )
    ordered = F.transform(F.array_sort(F.collect_set("_h")), lambda h: h["text"])
    return labelled.agg(F.array_join(ordered, "").alias("header"))
