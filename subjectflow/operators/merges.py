"""Joins that add columns or restrict populations, without multiplying rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subjectflow.functions.cells import col, if_else
from subjectflow.operators.joins import common_types, lookup_join
from subjectflow.operators.picks import pick_row


def _pairs(columns: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    """New name -> source name."""
    return dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}


def one_per_key(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The frame itself, failing at run time when a key occurs twice."""
    others = [c for c in df.columns if c not in by]
    grouped = df.groupBy(*by).agg(*[F.any_value(c).alias(c) for c in others], F.count("*").alias("_n"))
    keys = F.concat_ws(", ", *[F.col(k).cast("string") for k in by])
    checked = [
        F.when(F.col("_n") == 1, F.col(c)).otherwise(F.raise_error(F.concat(F.lit("duplicate key in merge: "), keys))).alias(c)
        for c in others
    ]
    return grouped.select(*by, *checked)


def merge_vars(
    df: DataFrame,
    add: DataFrame,
    by: Sequence[str],
    columns: Sequence[str] | Mapping[str, str],
    where: Column | None = None,
    order: Sequence[str | Column] | None = None,
    mode: str = "first",
    unique: bool = False,
    one_to_one: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Left-join columns of ``add`` by key, keeping the row count of ``df``.

    With ``order`` the first/last row per key is used; without it ``add`` must hold
    one row per key, which is checked at run time unless ``unique`` says it is known.
    ``one_to_one`` says that ``df`` holds one row per key too: no key can be hot, and a
    plain join keeps the partitioning that further joins on the key share. ``null_safe``:
    a missing key matches a missing key, as statistical languages join.
    """
    right = add if where is None else add.filter(where)
    if order is not None:
        right = pick_row(right, by, order, mode)
    right = right.select(*by, *[F.col(old).alias(new) for new, old in _pairs(columns).items()])
    if order is None and not unique:
        right = one_per_key(right, by)
    if one_to_one and not null_safe:
        return df.join(right, list(by), "left")
    return lookup_join(df, right, by, null_safe=null_safe)


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def population_right_join(df: DataFrame, population: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the population's subjects; a subject without rows stays with nulls.

    A right join could neither broadcast the population nor split a hot subject's rows.
    An inner join can do both, and the subjects without rows are added from an anti join
    against the distinct keys.
    """
    by = list(by)
    found = lookup_join(df, population, by, "inner")
    # the anti join compares in the common type, like the inner one
    kinds = common_types(population, df, by)
    seen = df.select(*[F.col(k).cast(kinds[k]).alias(f"_s_{k}") for k in by]).distinct()
    test = [F.col(k).cast(kinds[k]) == F.col(f"_s_{k}") for k in by]
    lone = population.join(seen, test, "left_anti")
    return found.unionByName(lone, allowMissingColumns=True)


def natural_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join on every shared column name."""
    return a.join(b, [c for c in a.columns if c in b.columns], "inner")


def stamp_full_join(df: DataFrame, marks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Full join that stamps a derived mark on all matching rows and keeps lone marks."""
    return marks.join(df, list(by), "full")


def supp_wide(
    supp: DataFrame, subject: Sequence[str], names: Sequence[str], seq: str, idvarval: str = "IDVARVAL",
    qnam: str = "QNAM", qval: str = "QVAL",
) -> DataFrame:
    """Name/value qualifier rows to one row per parent record, its key cast to a number."""
    cells = [F.max(F.when(F.col(qnam) == n, F.col(qval))).alias(n) for n in names]
    wide = supp.filter(F.col(qnam).isin(list(names))).groupBy(*subject, idvarval).agg(*cells)
    return wide.withColumn(seq, F.trim(F.col(idvarval)).try_cast("double")).drop(idvarval)


def join_supp(
    parent: DataFrame, supp: DataFrame, subject: Sequence[str], names: Sequence[str], seq: str, **columns
) -> DataFrame:
    """Attach supplemental qualifiers to their parent records.

    Keys are compared as numbers. Texts of one subject that read as the same number, such as
    ``1`` and `` 1``, would give a parent several rows: that is an error at run time.
    """
    wide = supp_wide(supp, subject, names, seq, **columns)
    wide = wide.withColumn(seq, F.col(seq).cast(parent.schema[seq].dataType)).filter(F.col(seq).isNotNull())
    return lookup_join(parent, one_per_key(wide, [*subject, seq]), [*subject, seq])


def map_codelist(
    df: DataFrame, codelist: DataFrame | Mapping, source: str, target: str, code: str = "code", decode: str = "decode",
    decode_to_code: bool = True,
) -> DataFrame:
    """Look ``source`` up in a codelist and put the partner value into ``target``.

    A literal mapping becomes an expression; a table is left-joined, and Spark
    broadcasts it only if its measured size allows. A code that occurs twice in the table
    is an error at run time.
    """
    if isinstance(codelist, Mapping):
        pairs = [F.lit(x) for kv in codelist.items() for x in kv]
        return df.withColumn(target, F.try_element_at(F.create_map(*pairs), F.col(source)))
    key, value = (decode, code) if decode_to_code else (code, decode)
    lookup = codelist.select(F.col(key).alias(source), F.col(value).alias(target))
    return lookup_join(df, one_per_key(lookup, [source]), [source])


def build_predecessors(
    sources: Mapping[str, DataFrame], mapping: Mapping[str, tuple[str, str]], base: str, keys: Sequence[str]
) -> DataFrame:
    """Assemble columns that map one-to-one from several tables.

    ``mapping`` gives target -> (table, column). ``base`` supplies the rows; the other
    tables hold one row per ``keys`` and are left-joined.
    """
    picked = {t: c for t, (table, c) in mapping.items() if table == base}
    out = sources[base].select(*[F.col(c).alias(t) for t, c in picked.items()],
                               *[k for k in keys if k not in picked])
    for table in sources:
        if table == base:
            continue
        wanted = {t: c for t, (tab, c) in mapping.items() if tab == table and t not in keys}
        if wanted:
            out = merge_vars(out, sources[table], keys, wanted)
    order = [t for t in mapping if t in out.columns]
    return out.select(*order, *[k for k in keys if k not in order])


def flag_or_keep(flag: str, other: str) -> Column:
    """Keep ``flag`` where it is 'Y', else take ``other`` (null test gives null)."""
    return if_else(col(flag) == "Y", col(flag), col(other))
