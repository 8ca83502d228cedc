"""Conformance rules as rows: each names a table, a test in SQL and a message.

All rules of a table become one expression, so a table is read once however many rules
there are, and rules can be kept, reviewed and extended as data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``test`` must not be false for any row of table ``scope``; where it is null, nothing is known and nothing violated."""

    id: str
    scope: str
    test: str
    message: str = ""


def rules_of(frame: DataFrame) -> list[Rule]:
    """Rules from a table with the columns ``id``, ``scope``, ``test`` and ``message``: metadata, some hundred rows."""
    found = [Rule(r["id"], r["scope"], r["test"], r["message"] or "") for r in frame.select("id", "scope", "test", "message").orderBy("id", "scope").collect()]
    keys = [(r.id, r.scope) for r in found]
    if len(set(keys)) < len(keys):
        raise ValueError("a rule occurs twice for one table")
    return found


def _violated(rules: Sequence[Rule]) -> Column:
    """The rules that a row violates, as an array of (rule, message)."""
    entries = [
        F.when(~F.coalesce(F.expr(f"CAST(({r.test}) AS BOOLEAN)"), F.lit(True)), F.struct(F.lit(r.id).alias("rule"), F.lit(r.message).alias("message"))) for r in rules
    ]
    return F.array_compact(F.array(*entries))


def violations(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """One row per violated rule of each row: ``keep``, ``rule``, ``message``."""
    return df.select(*keep, F.explode(_violated(rules)).alias("_v")).select(*keep, "_v.rule", "_v.message")


def check_rules(tables: Mapping[str, DataFrame], rules: Sequence[Rule], dataset: Mapping[str, str] | None = None, clean: bool = False) -> DataFrame:
    """``rule``, ``dataset``, ``message``, ``n``: violations counted over all tables, each read once.

    The dataset is the table's name, or for a table in ``dataset`` the value of that column (a
    table that describes others). ``clean`` also lists rules that no row violates, with 0, for
    tables that are their own dataset. A rule for a table that isn't there is an error.
    """
    missing = {r.scope for r in rules} - set(tables)
    if missing:
        raise ValueError(f"rules for unknown tables: {sorted(missing)}")
    out = None
    for name, df in tables.items():
        mine = [r for r in rules if r.scope == name]
        if not mine:
            continue
        column = (dataset or {}).get(name)
        if column is not None:
            found = violations(df.withColumn("dataset", F.col(column).cast("string")), mine, ["dataset"])
            part = found.groupBy("rule", "dataset", "message").agg(F.count("*").alias("n"))
        else:  # counts go to fixed places of one row
            counts = df.agg(*[F.count_if(~F.coalesce(F.expr(f"CAST(({r.test}) AS BOOLEAN)"), F.lit(True))).alias(f"_{i}") for i, r in enumerate(mine)])
            rows = F.array(*[F.struct(F.lit(r.id).alias("rule"), F.lit(name).alias("dataset"), F.lit(r.message).alias("message"), F.col(f"_{i}").alias("n")) for i, r in enumerate(mine)])
            part = counts.select(F.explode(rows).alias("_e")).select("_e.*")
            part = part if clean else part.filter("n > 0")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no rules")
    return out
